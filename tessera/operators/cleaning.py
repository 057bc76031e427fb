"""Cleaning of section records: normalisation, quality, document-level exact deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.quality import QualityRules, rejection_reason
from tessera.functions.text import estimate_tokens, exact_fingerprint, normalize_text
from tessera.sources.scratch import keep


def assemble_documents(records: DataFrame, keys: list[str], text_col: str = "text", ord_col: str = "ord", separator: str = "\n\n") -> DataFrame:
    """One row for each document: its sections' texts in order, and the first order value."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), F.col(text_col).alias("t"))))
    return records.groupBy(*keys).agg(F.min(ord_col).alias("first_ord"), F.array_join(F.transform(parts, lambda p: p["t"]), separator).alias("document_text"), F.count(F.lit(1)).alias("sections"))


def keep_first(docs: DataFrame, fingerprint_col: str, ord_col: str) -> DataFrame:
    """The first document of each fingerprint. A rank limit is applied before the shuffle."""
    w = Window.partitionBy(fingerprint_col).orderBy(ord_col)
    return docs.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def mark_duplicates(docs: DataFrame, fingerprint_col: str, ord_col: str, keys: list[str]) -> DataFrame:
    """Every document with duplicate_of: the keys of the first one of its fingerprint, null for that one itself.

    docs should be narrow (keys, order, fingerprint): the first is found by a map-side minimum and joined back, so
    that a fingerprint with very many copies is neither sorted nor held in one task.
    """
    first = docs.groupBy(fingerprint_col).agg(F.min(F.struct(ord_col, *keys)).alias("_first"))
    joined = docs.join(first, fingerprint_col)
    is_first = F.col("_first")[ord_col] == F.col(ord_col)
    return joined.withColumn("duplicate_of", F.when(~is_first, F.struct(*[F.col("_first")[k].alias(k) for k in keys]))).drop("_first")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column whose value is computed once for each row, however often it is referred to: projections are not merged
    across a generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def quality_checked(records: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Records with their normalised text and the reason for which they are rejected, if any."""
    normal = once(records, "text", normalize_text(F.col("text")))
    return once(normal, "reason", rejection_reason(F.col("text"), F.col("license"), rules))


def contiguity_violations(records: DataFrame, keys: list[str], block: list[str]) -> DataFrame:
    """Documents whose records do not stand next to each other in a file (block), by order value.

    A file is not sorted in one task: its order is cut into ranges, runs are counted in each, and a run that goes on from
    one range to the next is counted once.
    """
    spark = records.sparkSession
    ranged = records.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *block, "ord").withColumn("_range", F.spark_partition_id())
    w = Window.partitionBy(*block, "_range").orderBy("ord")
    key = F.struct(*keys)
    marked = ranged.withColumns({"_new": F.coalesce(key != F.lag(key).over(w), F.lit(True)), "_last": F.lead("ord").over(w).isNull(), "_first": F.lag("ord").over(w).isNull()})
    # kept, as ranges are only the same within one run
    runs = keep(marked.groupBy(*block, "_range", *keys).agg(F.sum(F.col("_new").cast("int")).alias("n"), F.max("_first").alias("first"), F.max("_last").alias("last")), "runs")
    ends = runs.where("last").select(*block, "_range", key.alias("end"))
    begins = runs.where("first").select(*block, "_range", key.alias("begin"))
    # one row for each range of a file
    order = Window.partitionBy(*block).orderBy("_range")
    joints = begins.join(ends, [*block, "_range"]).withColumn("before", F.lag("end").over(order)).where("begin = before").select(*block, *[F.col(f"begin.{k}").alias(k) for k in keys], F.lit(-1).cast("long").alias("n"))
    return runs.select(*block, *keys, "n").unionByName(joints).groupBy(*block, *keys).agg(F.sum("n").alias("runs")).where("runs > 1")


def clean_records(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of quality_checked() records that are kept in a table.

    Only records that pass count for a document's fingerprint. The join back carries keys and fingerprints, not texts.
    """
    keys = ["source", "document"]
    good = checked.where("reason is null")
    whole = assemble_documents(good, keys)
    marked = mark_duplicates(whole.select(*keys, "first_ord", exact_fingerprint(F.col("document_text")).alias("fingerprint")), "fingerprint", "first_ord", keys)
    verdict = good.join(marked.select(*keys, "fingerprint", "duplicate_of"), keys)
    meta = F.coalesce(F.try_parse_json("metadata"), F.parse_json(F.lit("{}")))
    with_sha = F.to_json(F.map_concat(F.coalesce(F.expr("try_variant_get(_m, '$', 'map<string,variant>')"), F.expr("cast(map() as map<string,variant>)")), F.create_map(F.lit("document_exact_sha256"), F.expr("cast(fingerprint as variant)"))))
    accepted = verdict.where("duplicate_of is null").withColumn("_m", meta).withColumns({"estimated_tokens": estimate_tokens(F.col("text")), "metadata": with_sha}).drop("_m", "reason", "duplicate_of", "fingerprint")
    nowhere = F.lit(None).cast("struct<source:string,document:string>")
    rejected = checked.where("reason is not null").select("id", *keys, "reason", nowhere.alias("duplicate_of")).unionByName(
        verdict.where("duplicate_of is not null").select("id", *keys, F.lit("exact_duplicate_document").alias("reason"), F.struct("duplicate_of.source", "duplicate_of.document").alias("duplicate_of"))
    )
    return accepted, rejected
