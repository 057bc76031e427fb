"""Length percentiles, counts and token sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import estimate_tokens


def length_summary(df: DataFrame, by: str, length: Column) -> DataFrame:
    """Rows, nearest-rank percentiles and the maximum of a length for each group.

    Lengths are counted first (map-side), so a group needs one row for each distinct length.
    """
    counted = df.select(F.col(by), length.cast("long").alias("v")).groupBy(by, "v").agg(F.count(F.lit(1)).alias("f"))
    w = Window.partitionBy(by)
    run = counted.withColumns({"upto": F.sum("f").over(w.orderBy("v")), "n": F.sum("f").over(w)})
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("n") * F.lit(q) / F.lit(100.0)), F.col("v")))
    return run.groupBy(by).agg(F.sum("f").alias("rows"), *[at(q).alias(f"p{q}") for q in (50, 90, 95, 99)], F.max("v").alias("max"))


#: Counters by name: functions from a text column to a token count column. A real tokenizer's counter may be added.
TOKEN_COUNTERS: dict[str, Callable[[Column], Column]] = {"estimate": estimate_tokens}


def source_counts(checked: DataFrame, accepted: DataFrame, rejected: DataFrame) -> dict[str, DataFrame]:
    """The cleaning stage's counters as small tables."""
    return {
        "input_documents_by_source": checked.select("source", "document").distinct().groupBy("source").count(),
        "accepted_documents_by_source": accepted.select("source", "document").distinct().groupBy("source").count(),
        "accepted_by_source": accepted.groupBy("source").count(),
        "estimated_tokens_by_source": accepted.groupBy("source").agg(F.sum("estimated_tokens").alias("count")),
        "rejected_by_reason": rejected.groupBy("reason").count(),
        "duplicate_documents_by_source": rejected.where("reason = 'exact_duplicate_document'").select("source", "document").distinct().groupBy("source").count(),
        "license_counts": accepted.groupBy("license").count(),
    }


def split_counts(records: DataFrame) -> DataFrame:
    """Records, documents and tokens for each source and split."""
    return records.groupBy("source", "split").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("document").alias("documents"), F.sum(F.coalesce("estimated_tokens", F.lit(0))).alias("tokens"))


def token_sum(records: DataFrame) -> DataFrame:
    return records.agg(F.sum(F.coalesce(F.col("estimated_tokens").cast("long"), F.lit(0))).alias("tokens"))
