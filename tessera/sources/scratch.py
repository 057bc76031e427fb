"""Tables between the steps of a plan, in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where none is set, as in tests, it is one in the warehouse."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    return there or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tessera-work"


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go as soon as it has ended. Else they stay until the driver's JVM finds in its garbage what
    referred to them, and it seldom looks at what has outlived a long job."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


_kept: list[tuple[SparkSession, str]] = []


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive executors.

    What is still there when the driver's process ends is removed then, and earlier by keep_result().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _kept.append((spark, path))
    with brief_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """keep() what make returns, and remove all tables that it kept on its way."""
    before = len(_kept)
    out = keep(make(), name)
    inner = _kept[before:-1]
    del _kept[before:-1]
    _remove(inner)
    return out


def _remove(tables: list[tuple[SparkSession, str]]) -> None:
    for spark, path in tables:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)


@atexit.register
def _remove_all() -> None:
    try:
        _remove(_kept)
    except Exception:  # noqa: BLE001 - the JVM may be gone; the folder is a scratch folder
        pass
    _kept.clear()
