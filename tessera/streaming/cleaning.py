"""Cleaning of a growing folder: each micro-batch is normalised and judged as in batch, and appended by verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.quality import QualityRules
from tessera.functions.text import exact_fingerprint
from tessera.operators.cleaning import quality_checked


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean_stream(records: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Judged records with a fingerprint of their text. Stateless: duplicates are found in batch, where order is known."""
    return quality_checked(records, rules).withColumn("fingerprint", exact_fingerprint(F.col("text")))


def start(records: DataFrame, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append judged records to output, partitioned by verdict; with once, until all files there now are done."""
    judged = clean_stream(records).withColumn("verdict", F.coalesce("reason", F.lit("accepted")))
    writer = judged.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).partitionBy("verdict")
    return (writer.trigger(availableNow=True) if once else writer).start()
