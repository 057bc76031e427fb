"""The conversation corpus end to end: sources -> canonical rows -> check -> split by source -> merge and shuffle.

run() does all of it and leaves a report for each stage; the parts can be used by themselves.
"""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tessera.functions.text import truthy
from tessera.operators.agent import convert_incidents
from tessera.operators.canonical import dumps, row_errors, validate, validation_summary
from tessera.operators.chat import ChatRules, check_chats, convert_tool_chats, sample_chats
from tessera.operators.splits import SPLITS, assign_by_share, assign_groups, keep_upstream, merge_shuffled
from tessera.operators.stats import TOKEN_COUNTERS, length_summary
from tessera.sources.readers import read_jsonl, row_numbers
from tessera.sources.scratch import keep
from tessera.sources.writers import counts, exists, utc_now, write_json, write_jsonl, write_lines


def canonical_chats(chats: DataFrame, excluded: DataFrame | None = None, original: str = "", rules: ChatRules | None = None) -> DataFrame:
    """id, source, row (canonical JSON) of the sampled general chats."""
    return canonical_rows(check_chats(chats, excluded, rules), original, rules)


def canonical_rows(checked: DataFrame, original: str = "", rules: ChatRules | None = None) -> DataFrame:
    """The same from check_chats() rows."""
    picked = sample_chats(checked, rules)
    turns = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    row = F.struct(
        F.col("id"), F.lit("general_sft").alias("source"), F.lit("general_instruction").alias("task_type"), F.lit("").alias("system"), F.array().cast("array<string>").alias("tools"), turns.alias("turns"),
        F.struct(F.lit(original).alias("original_source"), F.col("identifier").alias("original_id")).alias("metadata"),
    )
    return picked.select("id", F.lit("general_sft").alias("source"), F.to_json(row).alias("row"))


def rejected_counts(checked: DataFrame) -> DataFrame:
    return checked.where("reason is not null").groupBy("reason").count()


def checked_rows(rows: DataFrame, strict: bool = False) -> DataFrame:
    """rows with their errors; strict: any error stops the run."""
    out = validate(rows.withColumn("ord", F.lit(0)) if "ord" not in rows.columns else rows, "row", "source")
    if strict:
        bad = validation_summary(out).agg(F.sum("errors")).first()[0]
        if bad:
            raise RuntimeError(f"{bad} errors in canonical rows")
    return out


def split_and_merge(general: DataFrame, tools: DataFrame, agents: DataFrame, seed: int = 42) -> DataFrame:
    """id, source, row, split of all rows, each source split in its own way first, then shuffled within each split."""
    g = general.join(assign_by_share(general, "id", seed), "id")
    t = tools.withColumn("split", keep_upstream(F.get_json_object("row", "$.metadata.upstream_split")))
    kind = F.get_json_object("row", "$.metadata.failure_type")
    named = agents.withColumn("group", kind)
    a = named.join(assign_groups(named, "group", seed), "group").drop("group")
    cols = ["id", "source", "row", "split"]
    merged = merge_shuffled(g.select(*cols), t.select(*cols), a.select(*cols), seed=seed)
    return merged.withColumn("row", with_split("row", "split"))


@F.pandas_udf(StringType())
def with_split(rows: pd.Series, splits: pd.Series) -> pd.Series:
    """Canonical rows whose metadata names their split."""

    def one(text: str, split: str) -> str:
        row = json.loads(text)
        row["metadata"]["split"] = split
        return dumps(row)

    return pd.Series([one(t, s) for t, s in zip(rows, splits)], dtype=object)


def validate_files(spark: SparkSession, paths: list[str], reports: str, strict: bool = True) -> dict[str, Any]:
    """Check files of canonical rows: an error table (file, row_number, id, errors) and a summary in reports.

    A file that is missing is an error of its own. Row numbers count lines that are not blank, from 1; of rows with one id all
    but the first, in the order of paths, are errors. strict: any error stops the run, after the reports are written.
    """
    missing = [p for p in paths if not exists(spark, p)]
    errors = spark.createDataFrame([(p, None, None, ["file does not exist"]) for p in missing], "file string, row_number long, id string, errors array<string>")
    rows = None
    for k, p in enumerate(paths):
        if p not in missing:
            one = read_jsonl(spark, p, strict=False, source_number=k).select(F.lit(p).alias("file"), "ord", "value")
            rows = one if rows is None else rows.unionByName(one)
    sources: dict[str, int] = {}
    if rows is not None:
        id_ = F.coalesce(F.get_json_object("value", "$.id"), F.lit(""))
        source = F.coalesce(truthy(F.get_json_object("value", "$.source")), F.lit("unknown"))
        checked = keep(rows.select("file", "ord", id_.alias("id"), source.alias("source"), row_errors(F.col("value")).alias("errors")), "validated")
        sources = counts(checked.groupBy("source").count())
        first = checked.groupBy("id").agg(F.min(F.struct("ord", "file")).alias("first"))
        again = F.when(F.col("first.ord") != F.col("ord"), F.array(F.concat(F.lit("duplicate id; first seen in "), F.col("first.file")))).otherwise(F.array().cast("array<string>"))
        bad = checked.join(first, "id").withColumn("errors", F.concat("errors", again)).where(F.size("errors") > 0)
        # a path may be a folder of part files, which count in the order of their names
        numbers = row_numbers(checked.select("ord"))
        sizes = numbers.groupBy(F.col("ord.source").alias("path"), F.col("ord.file").alias("part")).agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("path", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        placed = bad.join(numbers, "ord").join(offsets, (F.col("ord.source") == F.col("path")) & (F.col("ord.file") == F.col("part")))
        errors = errors.unionByName(placed.select("file", (F.col("offset") + F.col("row_in_file") + 1).alias("row_number"), truthy(F.col("id")).alias("id"), "errors"))
    invalid = write_jsonl(errors, f"{reports.rstrip('/')}/validation_errors.jsonl", gzip=False)
    report = {"files": paths, "rows": sum(sources.values()), "rows_by_source": sources, "invalid_rows": invalid}
    write_json(f"{reports.rstrip('/')}/validation_summary.json", report, spark)
    if invalid and strict:
        raise RuntimeError(f"{invalid} invalid rows; see {reports}")
    return report


def run(output: str, chats: DataFrame, tools: DataFrame, incidents: DataFrame, excluded: DataFrame | None = None, system: str = "", rules: ChatRules | None = None, seed: int = 42, strict: bool = True) -> dict[str, Any]:
    """The whole corpus: chats (prompt_id, messages, ord), tool rows (value, index, file), gathered incidents.

    Writes intermediate/<source>.jsonl, canonical/<split>.jsonl and reports below output; returns the reports by stage.
    """
    spark, base = chats.sparkSession, output.rstrip("/")
    reports = f"{base}/reports"
    done: dict[str, Any] = {}
    checked = keep(check_chats(chats, excluded, rules), "checked-chats")
    converted = keep(convert_tool_chats(tools, split_col="file"), "tool-chats")
    traces = keep(convert_incidents(incidents, system), "traces")
    made = {
        "general_sft": (canonical_rows(checked, rules=rules), checked, "input_rows_seen"),
        "functiongemma_network": (converted.where("reason is null").select("row"), converted, "input_rows"),
        "nika": (traces.where("reason is null").select("row"), traces, "incidents"),
    }
    parts: dict[str, DataFrame] = {}
    paths = [f"{base}/intermediate/{name}.jsonl" for name in made]
    for path, (name, (rows, judged, counted)) in zip(paths, made.items()):
        lines = write_lines(rows, path, "row", gzip=False)
        done[name] = {counted: judged.count(), "output_rows": lines, "rejected": counts(rejected_counts(judged))}
        write_json(f"{reports}/{name}.json", done[name], spark)
        parts[name] = spark.read.text(path).select(F.get_json_object("value", "$.id").alias("id"), F.lit(name).alias("source"), F.col("value").alias("row"))
    done["validate_intermediate"] = validate_files(spark, paths, f"{reports}/intermediate", strict)
    merged = keep(split_and_merge(*parts.values(), seed=seed), "merged")
    finals = [f"{base}/canonical/{s}.jsonl" for s in SPLITS]
    for s, path in zip(SPLITS, finals):
        write_lines(merged.where(F.col("split") == s).orderBy("shuffle_key"), path, "row", gzip=False)
    done["merge"] = {"split_order": "each source first, merge second"} | merge_manifest(merged, seed)
    write_json(f"{base}/canonical/dataset_manifest.json", done["merge"], spark)
    done["validate_canonical"] = validate_files(spark, finals, f"{reports}/canonical", strict)
    lengths = token_statistics(merged).orderBy("source").collect()
    done["statistics"] = {"created_at": utc_now(), "tokenizer": "estimate", "splits": done["merge"]["rows"], "datasets": {r["source"]: {k: r[k] for k in ("rows", "p50", "p90", "p95", "p99", "max")} for r in lengths}}
    write_json(f"{reports}/dataset_stats.json", done["statistics"], spark)
    return done


def merge_manifest(merged: DataFrame, seed: int = 42) -> dict[str, Any]:
    table = merged.groupBy("source", "split").count().collect()
    unseen = merged.where("split = 'test'").select(F.get_json_object("row", "$.metadata.failure_type").alias("f")).where("f is not null").distinct().orderBy("f").collect()
    by_source: dict[str, dict[str, int]] = {}
    for r in table:
        by_source.setdefault(r["source"], {})[r["split"]] = r["count"]
    rows = {s: sum(v.get(s, 0) for v in by_source.values()) for s in ("train", "validation", "test")}
    return {"seed": seed, "rows": rows, "rows_by_source": by_source, "test_unseen_failure_types": [r["f"] for r in unseen]}


def token_statistics(merged: DataFrame, counter: str = "estimate") -> DataFrame:
    """Length percentiles of rendered rows for each source, by a registered token counter."""
    from tessera.operators.canonical import rendered

    shown = merged.withColumn("_r", rendered(F.col("row"))).withColumn("_text", F.concat("_r.messages", "_r.tools"))
    return length_summary(shown, "source", TOKEN_COUNTERS[counter](F.col("_text")))
