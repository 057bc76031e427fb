"""Readers. Every reader attaches ord, a sortable order value, since Spark keeps no order of its own:
the source's number, the file's path, the block and the row within it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import config
from tessera.functions.text import estimate_tokens, stable_id, truthy
from tessera.functions.values import metadata_object
from tessera.operators.chat import global_index
from tessera.operators.sections import markdown_chapters, markdown_sections, rst_sections

FIELDS = ("id", "source", "document", "title", "license", "language", "text", "snapshot", "section", "estimated_tokens", "metadata")
RECORD = "id string, source string, document string, title string, license string, language string, text string, snapshot string, section string, estimated_tokens long, metadata string"
ORDER = "struct<source:int,file:string,block:long,row:long>"
# Fixed value: chapters of a manual that are not content.
EXCLUDED_CHAPTERS = r"(?i)\b(install(?:ation|ing)?|build (?:requirements|dependencies)|release notes?|copyright)\b"


def _ordered(df: DataFrame, source_number: int) -> DataFrame:
    """Lines with their place. Row numbers of a task rise within a block of a file."""
    return df.withColumn("ord", F.struct(F.lit(source_number).alias("source"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))


def read_jsonl(spark: SparkSession, path: str | list[str], strict: bool = True, source_number: int = 0, glob: str | None = None) -> DataFrame:
    """JSON lines as text: value, v (variant), file, ord. Blank lines are skipped and a byte order mark is dropped; gzip goes by suffix.

    strict: a line that is no JSON object stops the run. Otherwise it comes with a null v.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = _ordered(reader.text(path), source_number).select(F.regexp_replace("value", "^﻿", "").alias("value"), "ord", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    v = F.try_parse_json("value")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    bad = F.raise_error(F.concat(F.lit("not a JSON object in "), F.col("file"), F.lit(": "), F.substring("value", 1, 80))) if strict else F.lit(None)
    return lines.withColumn("v", F.when(is_object, v).otherwise(bad.cast("variant")))


def row_numbers(lines: DataFrame) -> DataFrame:
    """ord, row_in_file of all lines: their number among the file's lines, from 0. Only order values are moved, block by block."""
    narrow = lines.select("ord", F.col("ord.file").alias("file"), F.col("ord.block").alias("block"))
    sizes = narrow.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each block of a file
    offsets = sizes.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = narrow.withColumn("own", F.row_number().over(Window.partitionBy("file", "block").orderBy("ord.row")) - 1)
    return own.join(offsets, ["file", "block"]).select("ord", (F.col("offset") + F.col("own")).alias("row_in_file"))


def _numbered(rows: DataFrame, missing: Column, numbers: DataFrame, name: str) -> DataFrame:
    """rows with a number for those that miss an identifier; the others are not moved for it."""
    some = rows.where(missing).join(numbers, "ord").select(*[F.col(f"`{c}`") for c in rows.columns], name)
    return rows.where(~missing).withColumn(name, F.lit(None).cast("long")).unionByName(some)


def read_parquet_rows(spark: SparkSession, path: str, source_number: int = 0) -> DataFrame:
    """Parquet rows of all files below path, with ord."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    return df.withColumn("ord", F.struct(F.lit(source_number).alias("source"), F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("block"), F.col("_metadata.row_index").alias("row")))


def read_whole_files(spark: SparkSession, path: str, globs: tuple[str, ...] = ("*",), source_number: int = 0) -> DataFrame:
    """One row for each file: path, content, value (bytes that are not UTF-8 become U+FFFD), ord."""
    found = None
    for g in globs:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", g).load(path).select("path", "content")
        found = one if found is None else found.unionByName(one)
    whole = found.dropDuplicates(["path"]) if len(globs) > 1 else found
    return whole.withColumn("value", F.make_valid_utf8(F.col("content").cast("string"))).withColumn("ord", F.struct(F.lit(source_number).alias("source"), F.col("path").alias("file"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("row")))


def file_digests(files: DataFrame) -> DataFrame:
    """sha256 and md5 of whole files."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def _record(df: DataFrame, **fields: Column) -> DataFrame:
    return df.select(*[fields[f].cast("long" if f == "estimated_tokens" else "string").alias(f) for f in FIELDS], "ord")


def _text_of(path: str) -> Column:
    """A field's text; null if it is absent or null."""
    return F.expr(f"try_variant_get(v, '$.{path}', 'string')")


def article_records(lines: DataFrame, revision: str) -> DataFrame:
    """Records of the article corpus: subset folders of JSON lines with ID, Category, Content, Metadata."""
    subset = F.element_at(F.split("ord.file", "/"), -2)
    own = F.coalesce(truthy(_text_of("ID")), truthy(_text_of("id")))
    lines = _numbered(lines, own.isNull(), row_numbers(lines), "row_in_file")
    key = F.coalesce(own, F.concat(subset, F.lit("-"), F.col("row_in_file").cast("string")))
    category = F.coalesce(truthy(_text_of("Category")), truthy(_text_of("category")), subset)
    text = F.coalesce(truthy(_text_of("Content")), truthy(_text_of("content")), F.lit(""))
    raw = F.coalesce(F.expr("try_variant_get(v, '$.Metadata', 'string')"), F.expr("to_json(try_variant_get(v, '$.Metadata', 'variant'))"), F.expr("try_variant_get(v, '$.metadata', 'string')"))
    kept = lines.withColumns({"_key": key, "_category": category, "_text": text, "_meta": metadata_object(raw)})
    document = F.concat("_category", F.lit("/"), "_key")
    m = F.col("_meta")
    return _record(
        kept, id=F.concat(F.lit("tele-"), stable_id(document, F.col("_text"))), source=F.lit("tele_data"), document=document, section=F.col("_category"),
        title=F.coalesce(truthy(F.get_json_object(m, "$.title")), truthy(F.get_json_object(m, "$.Title")), F.col("_key")), license=F.lit(config.CARD_LICENSE), language=F.lit("en"),
        text=F.col("_text"), snapshot=F.lit(revision), estimated_tokens=estimate_tokens(F.col("_text")), metadata=F.concat(F.lit('{"category":'), F.to_json(F.parse_json(F.to_json(F.array("_category")))).substr(F.lit(2), F.length(F.to_json(F.array("_category"))) - 2), F.lit(',"upstream":'), m, F.lit("}")),
    )


def collection_records(rows: DataFrame, revision: str) -> DataFrame:
    """Records of the collection corpus: Parquet with identifier, collection, title, license, language, token_count, text and more."""
    has = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    # rows without an identifier have their number over all files
    places = global_index(rows.select("ord", F.col("ord.file").alias("file"), F.col("ord.row").alias("row")), "file", "row").select("ord", F.col("index").alias("_number"))
    columns, own = rows.columns, truthy(has("identifier"))
    rows = _numbered(rows, own.isNull(), places, "_number")
    key = F.coalesce(own, F.concat(F.lit("row-"), F.col("_number").cast("string")))
    text, group = F.coalesce(has("text"), F.lit("")), F.coalesce(truthy(has("collection")), F.lit("unknown"))
    rest = [c for c in columns if c not in ("text", "identifier", "title", "license", "language", "token_count", "ord")]
    tokens = F.nullif(F.col("token_count").cast("long"), F.lit(0).cast("long")) if "token_count" in rows.columns else F.lit(None)
    return _record(
        rows, id=F.concat(F.lit("gsma-"), stable_id(key, text)), source=F.lit("gsma_tcc"), document=F.concat(group, F.lit("/"), key), section=group, title=F.coalesce(truthy(has("title")), key),
        license=F.coalesce(truthy(has("license")), F.lit(config.UNKNOWN_LICENSE)), language=F.coalesce(truthy(has("language")), F.lit("en")), text=text, snapshot=F.lit(revision),
        estimated_tokens=F.coalesce(tokens, estimate_tokens(text)), metadata=F.to_json(F.struct(*[F.col(c) for c in sorted(rest)]), {"ignoreNullFields": "false"}) if rest else F.lit("{}"),
    )


def repository_records(files: DataFrame, source: str, root: str, revision: str, licenses: list[str], markdown: bool) -> DataFrame:
    """Records of a repository's documentation files, one for each section."""
    relative = F.regexp_replace("path", "^.*?" + "".join(f"\\{c}" if not c.isalnum() and c != "/" else c for c in root.rstrip("/")) + "/", "")
    named = files.withColumns({"document": relative, "stem": F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")})
    cut = (markdown_sections if markdown else rst_sections)(named, "value", F.col("stem"))
    return _record(
        cut, id=F.concat(F.lit(f"{source}-"), stable_id(F.col("document"), F.col("section_no"), F.col("body"))), source=F.lit(source), document=F.col("document"), title=F.col("section_title"),
        section=F.concat("document", F.lit("#"), F.col("section_no").cast("string")), license=F.lit(config.REPOSITORY_LICENSE), language=F.lit("en"), text=F.col("body"), snapshot=F.lit(revision),
        estimated_tokens=estimate_tokens(F.col("body")), metadata=F.to_json(F.struct(F.col("document").alias("path"), F.array(*[F.lit(x) for x in licenses]).cast("array<string>").alias("repository_license_files"))),
    ).withColumn("ord", F.struct("ord.source", "ord.file", "ord.block", F.regexp_extract("section", r"#(\d+)$", 1).cast("long").alias("row")))


def manual_records(files: DataFrame, revision: str, version: str, title: str, excluded: str = EXCLUDED_CHAPTERS) -> DataFrame:
    """Records of a manual that was converted to Markdown, one for each chapter; numbers count all chapters, also those left out."""
    text = files.withColumn("value", F.replace("value", F.lit("\x00"), F.lit("")))
    cut = markdown_chapters(text, "value", F.lit(title)).where(~F.col("section_title").rlike(excluded))
    document = F.concat(F.lit(f"Kea-ARM-{version}/"), F.format_string("%04d", "section_no"), F.lit("-"), stable_id(F.col("section_title")))
    return _record(
        cut, id=F.concat(F.lit("kea-"), stable_id(document, F.col("body"))), source=F.lit("kea"), document=document, title=F.col("section_title"), section=F.concat(F.lit("chapter-"), F.col("section_no").cast("string")),
        license=F.lit(config.MANUAL_LICENSE), language=F.lit("en"), text=F.col("body"), snapshot=F.lit(revision), estimated_tokens=estimate_tokens(F.col("body")),
        metadata=F.to_json(F.struct(F.lit("repeated_shallowest_markdown_heading").alias("document_boundary"), F.col("path").alias("markdown"), F.lit(version).alias("version"))),
    ).withColumn("ord", F.struct("ord.source", "ord.file", "ord.block", F.regexp_extract("section", r"(\d+)$", 1).cast("long").alias("row")))


#: Parsers by source; others can be added under new names.
PARSERS = {"tele_data": article_records, "gsma_tcc": collection_records, "repository": repository_records, "kea": manual_records}


def union_sources(parts: dict[str, DataFrame], enabled: tuple[str, ...] = config.SOURCES) -> DataFrame:
    """All enabled sources' records, ord led by the source's place in the list."""
    out = None
    for n, name in enumerate(enabled):
        if name in parts:
            one = parts[name].withColumn("ord", F.struct(F.lit(n).alias("source"), "ord.file", "ord.block", "ord.row"))
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no enabled source has records")
    return out


def records_from_rows(rows: DataFrame) -> DataFrame:
    """Any table as records: absent columns are empty, metadata that is no JSON goes under raw_metadata, null counts are 0."""
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    meta = F.col("metadata").cast("string") if "metadata" in rows.columns else F.lit(None).cast("string")
    fixed = F.when(meta.isNull() | (meta == ""), F.lit("{}")).when(F.try_parse_json(meta).isNull(), F.to_json(F.struct(meta.alias("raw_metadata")))).otherwise(meta)
    tokens = F.coalesce(F.col("estimated_tokens").cast("long"), F.lit(0)) if "estimated_tokens" in rows.columns else F.lit(0)
    return rows.select(*[(fixed if f == "metadata" else tokens.cast("long") if f == "estimated_tokens" else has(f)).alias(f) for f in FIELDS], *(["ord"] if "ord" in rows.columns else []))


def require_identity(records: DataFrame) -> DataFrame:
    """Records without an id, source, document or license stop the run; an empty text does not, cleaning records it."""
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in ("id", "source", "document", "license")]))
    return records.withColumn("id", F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("record without "), F.array_join(missing, ", ")))).otherwise(F.col("id")))


def load_splits(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "validation", "test")) -> dict[str, DataFrame]:
    """The splits' tables; one that is missing, empty or without a text column is an error."""
    out = {}
    for s in splits:
        df = spark.read.parquet(f"{folder}/{s}.parquet")
        if "text" not in df.columns:
            raise ValueError(f"{s} has no text column")
        if df.isEmpty():
            raise ValueError(f"{s} is empty")
        out[s] = df
    return out


def license_files(names: list[str]) -> list[str]:
    """The license files among a repository root's names."""
    return sorted({n for n in names if n.startswith(("LICENSE", "COPYING", "NOTICE"))})
