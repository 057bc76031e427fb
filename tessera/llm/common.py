"""What the operators share: reading tables, tables kept in the shared folder, the learning rows."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import brief_shuffles, keep, keep_result, shared_dir

__all__ = ["brief_shuffles", "keep", "keep_result", "shared_dir"]

BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one of fewer splits than there are cores is dealt to all of them."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"{n}_"
        taken.add(n.lower())
        out.append(n)
    return out


def small_batches(df: DataFrame) -> DataFrame:
    """Texts are long: no more than BATCH_ROWS of them go to Python at once. Spark knows this limit by session only, so it
    is lowered for the session's other queries too, whose results do not depend on it."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(name, "10000")) > BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3; remainder 1 is held out of learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    """A null id has no remainder and is not held out."""
    return F.coalesce(fold_of(doc_id) == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) != 1, F.lit(False))


RANGE = 1 << 40


def place(id_: Column) -> Column:
    """A row's place in [0, RANGE) by a hash of its id."""
    return F.pmod(F.xxhash64(id_), F.lit(RANGE))


def sample_limits(sizes: dict, rows: int) -> dict:
    """For groups of these sizes, the places below which about twice as many rows as wanted lie, so that choosing the
    first ones of a group is work for a bounded number of rows."""
    return {k: RANGE if n <= 4 * rows else RANGE * 2 * rows // n for k, n in sizes.items()}


_caches: dict[str, dict] = {}


def give_back() -> None:
    """Return what is free to the system: Spark's Python workers live on between tasks."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def worker_cache(owner: str) -> dict:
    """An operator's tables and automata in a Python worker. One operator's at a time: a worker that goes on to
    another stage drops those of the last one."""
    if any(c for n, c in _caches.items() if n != owner):
        for n, c in _caches.items():
            if n != owner:
                c.clear()
        give_back()
    return _caches.setdefault(owner, {})
