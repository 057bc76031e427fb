"""The document corpus end to end: records -> cleaning -> split by source -> Parquet and manifests."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import CorpusConfig
from tessera.functions.quality import QualityRules
from tessera.operators.cleaning import clean_records, quality_checked
from tessera.operators.splits import assign_by_source, split_records
from tessera.operators.stats import source_counts, split_counts
from tessera.sources.readers import RECORD, require_identity, union_sources
from tessera.sources.writers import counts, utc_now, write_json, write_splits

STAMP = "created_at"


def _table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """A stage's table: written once, read by all that follow."""
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(records: DataFrame, work: str, config: CorpusConfig | None = None) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
    """(accepted, rejected, manifest). work: a folder that all executors share."""
    config = config or CorpusConfig()
    checked = _table(quality_checked(records, QualityRules(min_chars=config.min_chars)), work, "checked")
    accepted, rejected = clean_records(checked)
    accepted, rejected = _table(accepted, work, "accepted"), _table(rejected, work, "rejected")
    manifest: dict[str, Any] = {"stage": "clean", STAMP: utc_now(), "dedup": "document-level normalized exact SHA-256 before split"}
    manifest |= {k: counts(v) for k, v in source_counts(checked, accepted, rejected).items()}
    manifest |= {"accepted_documents": sum(manifest["accepted_documents_by_source"].values()), "accepted_records": sum(manifest["accepted_by_source"].values())}
    return accepted, rejected, manifest


def split(accepted: DataFrame, config: CorpusConfig | None = None) -> DataFrame:
    config = config or CorpusConfig()
    config.validate()
    return split_records(accepted, assign_by_source(accepted, config.seed, config.ratios))


def build(records: DataFrame, output: str, work: str, config: CorpusConfig | None = None) -> dict[str, Any]:
    """Clean, split and write; returns the manifests of both stages."""
    config = config or CorpusConfig()
    accepted, _, cleaning = clean(require_identity(records), work, config)
    placed = _table(split(accepted, config), work, "split")
    names = [f.strip().split(" ")[0] for f in RECORD.split(",")]
    rows = write_splits(placed.select(*names, "split"), output)
    table = split_counts(placed).collect()
    manifest: dict[str, Any] = {"stage": "document_level_split", STAMP: utc_now(), "seed": config.seed, "ratios": dict(zip(("train", "validation", "test"), config.ratios)), "group_key": ["source", "document"], "records": rows}
    manifest["records_by_source_and_split"], manifest["documents_by_source_and_split"] = {}, {}
    for r in table:
        manifest["records_by_source_and_split"].setdefault(r["source"], {})[r["split"]] = r["records"]
        manifest["documents_by_source_and_split"].setdefault(r["source"], {})[r["split"]] = r["documents"]
    manifest["estimated_tokens"] = {s: sum(r["tokens"] for r in table if r["split"] == s) for s in ("train", "validation", "test")}
    manifest["unique_documents"] = sum(r["documents"] for r in table)
    write_json(f"{output.rstrip('/')}/dataset_manifest.json", manifest, records.sparkSession)
    return {"clean": cleaning, "split": manifest}


def parse(parts: dict[str, DataFrame], output: str, config: CorpusConfig | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """All enabled sources' records, checked and written to output, and the stage's manifest beside them."""
    records = require_identity(union_sources(parts, (config or CorpusConfig()).enabled_sources))
    path, spark = f"{output.rstrip('/')}/documents.parquet", records.sparkSession
    records.write.mode("overwrite").option("compression", "zstd").parquet(path)
    written = spark.read.schema(records.schema).parquet(path)
    table = parse_counts(written).collect()
    manifest = {
        "stage": "parse", STAMP: utc_now(), "output": path, "records": sum(r["records"] for r in table), "estimated_tokens": sum(r["tokens"] for r in table),
        "records_by_source": {r["source"]: r["records"] for r in table}, "estimated_tokens_by_source": {r["source"]: r["tokens"] for r in table},
    }
    write_json(f"{output.rstrip('/')}/manifest.json", manifest, spark)
    return written, manifest


def run(parts: dict[str, DataFrame], output: str, work: str, config: CorpusConfig | None = None) -> dict[str, Any]:
    """The whole corpus from the sources' records: parse, clean, split, with a manifest for each stage."""
    records, manifest = parse(parts, f"{work.rstrip('/')}/parsed", config)
    return {"parse": manifest} | build(records, output, work, config)


def parse_counts(records: DataFrame) -> DataFrame:
    """Records and tokens of each source after parsing."""
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum("estimated_tokens").alias("tokens"))
