"""Writers: JSON lines, Parquet splits and manifests. Data files are committed by Spark, manifests by a rename."""

from __future__ import annotations

import json
import math
import os
import platform
import tempfile
from dataclasses import asdict
from datetime import datetime, timezone
from importlib import metadata
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, col: str, gzip: bool = True, mode: str = "overwrite") -> int:
    """A text column as lines; the number of lines."""
    seen = Observation()
    df.select(F.col(col).alias("value")).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "gzip" if gzip else "none").text(path)
    return seen.get["rows"]


def write_jsonl(df: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite") -> int:
    """Compact lines with keys in order; append with mode "append". The number of rows."""
    return write_lines(df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])).alias("value")), path, "value", gzip, mode)


def write_splits(df: DataFrame, folder: str, splits: tuple[str, ...] = ("train", "validation", "test"), split_col: str = "split") -> dict[str, int]:
    """One zstd Parquet table for each split, also for empty ones; rows of each. A success file tells readers that all are there.

    df is read once for each split: keep it in a table first.
    """
    spark = df.sparkSession
    rows = {}
    for s in splits:
        part = df.where(F.col(split_col) == s).drop(split_col)
        part.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{s}.parquet")
        rows[s] = spark.read.schema(part.schema).parquet(f"{folder}/{s}.parquet").count()
    spark.createDataFrame([(json.dumps(rows, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_counts")
    return rows


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _plain(value: Any) -> Any:
    return None if isinstance(value, float) and not math.isfinite(value) else value


def counts(df: DataFrame) -> dict[str, Any]:
    """A small table of names and counts as a dict; the name is the first column, the count the last."""
    return {str(r[0]): _plain(r[-1]) for r in df.collect()}


def write_json(path: str, payload: dict[str, Any], spark: SparkSession | None = None) -> None:
    """A manifest, written aside and renamed; through Spark's file systems if a session is given, so that any path will do."""
    text = json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n"
    if spark is not None:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
        system = target.getFileSystem(conf)
        out = system.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        system.delete(target, False)
        if not system.rename(aside, target):
            raise OSError(f"cannot write {path}")
        return
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, aside = tempfile.mkstemp(dir=folder, suffix=".part")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(aside, path)
    except BaseException:
        os.unlink(aside)
        raise


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_run_config(folder: str, config: Any, packages: tuple[str, ...] = ("pyspark", "pyarrow", "pandas"), spark: SparkSession | None = None) -> dict[str, Any]:
    """A run's settings (a dataclass or a dict) and the versions it ran with, as run_config.json."""
    versions = {"python": platform.python_version()}
    for name in packages:
        try:
            versions[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            versions[name] = None
    payload = {"config": dict(config) if isinstance(config, dict) else asdict(config), "versions": versions}
    write_json(f"{folder.rstrip('/')}/run_config.json", payload, spark)
    return payload


class TraceWriter:
    """Appends scalar metrics of a run as JSON lines, on the first process only."""

    def __init__(self, path: str, rank: int = 0) -> None:
        self.path, self.rank = path, rank

    def log(self, step: int, metrics: dict[str, Any]) -> None:
        if self.rank == 0:
            scalars = {k: v for k, v in metrics.items() if isinstance(v, (bool, int, float, str))}
            with open(self.path, "a", encoding="utf-8") as f:
                f.write(json.dumps({"step": step, **scalars}, sort_keys=True) + "\n")
