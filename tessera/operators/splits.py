"""Deterministic splits: by source with largest remainders, by rounded shares, by held-out groups, and shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import document_sort_key, seeded_hash

SPLITS = ("train", "validation", "test")


def allocate_counts(total: Column, ratios: tuple[float, float, float] = (0.9, 0.05, 0.05)) -> list[Column]:
    """Largest remainders: how many of total go to each split; ties go to the earlier split."""
    quotas = [total * F.lit(float(r)) for r in ratios]
    floors = [F.floor(q) for q in quotas]
    over = [q - f for q, f in zip(quotas, floors)]
    left = total - sum(floors[1:], floors[0])
    out = []
    for k, f in enumerate(floors):
        ahead = sum([F.when(over[j] > over[k], 1).when((over[j] == over[k]) & F.lit(j < k), 1).otherwise(0) for j in range(len(over)) if j != k], F.lit(0))
        out.append((f + F.when(ahead < left, 1).otherwise(0)).cast("long"))
    return out


def ranked(df: DataFrame, by: list[str], key: Column, buckets: int = 256) -> DataFrame:
    """df with n, the size of each group, and rn, the row's place in it by key (hexadecimal hash).

    A large group is not sorted in one task: a hash's first two digits deal it into ranges, which are
    ranked apart and shifted by the sizes of those before. Ties in key are broken by the hash of the row.
    """
    keyed = df.withColumn("_key", key).withColumn("_range", F.conv(F.substring("_key", 1, 2), 16, 10).cast("int"))
    sizes = keyed.groupBy(*by, "_range").count()
    w = Window.partitionBy(*by).orderBy("_range")
    # at most 256 rows for each group
    places = sizes.select(*by, "_range", F.coalesce(F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("count").over(Window.partitionBy(*by)).alias("n"))
    own = keyed.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_range").orderBy("_key", F.xxhash64(*df.columns))))
    return own.join(places, [*by, "_range"]).withColumn("rn", F.col("_before") + F.col("_own")).drop("_key", "_range", "_before", "_own")


def assign_by_source(documents: DataFrame, seed: int = 42, ratios: tuple[float, float, float] = (0.9, 0.05, 0.05)) -> DataFrame:
    """source, document, split of the distinct documents; each source is divided by itself."""
    named = documents.select(F.col("source").cast("string").alias("source"), F.col("document").cast("string").alias("document")).distinct()
    placed = ranked(named, ["source"], document_sort_key(F.col("source"), F.col("document"), seed))
    train, validation, _ = allocate_counts(F.col("n"), ratios)
    split = F.when(F.col("rn") <= train, "train").when(F.col("rn") <= train + validation, "validation").otherwise("test")
    return placed.select("source", "document", split.alias("split"))


def split_records(records: DataFrame, assignments: DataFrame) -> DataFrame:
    """Records with their document's split; only documents held out are looked up, the others are for training."""
    held = assignments.where("split <> 'train'")
    return records.join(held, ["source", "document"], "left").withColumn("split", F.coalesce("split", F.lit("train")))


def assign_by_share(rows: DataFrame, id_col: str, seed: int = 42, share: float = 0.05) -> DataFrame:
    """id, split: shares rounded half to even, at least one each from twenty rows on."""
    placed = ranked(rows.select(F.col(id_col).cast("string").alias("id")).withColumn("_all", F.lit(0)), ["_all"], seeded_hash(F.col("id"), seed))
    rounded = F.bround(F.col("n") * F.lit(share))
    each = F.when(F.col("n") >= 20, F.greatest(F.lit(1.0), rounded)).otherwise(rounded)
    split = F.when(F.col("rn") <= F.col("n") - 2 * each, "train").when(F.col("rn") <= F.col("n") - each, "validation").otherwise("test")
    return placed.select("id", split.alias("split"))


def keep_upstream(split: Column) -> Column:
    """The split a row came with, if it is one."""
    return F.when(split.isin(*SPLITS), split).otherwise(F.lit("train"))


def assign_groups(rows: DataFrame, group_col: str, seed: int = 42, share: float = 0.05, strict: bool = True) -> DataFrame:
    """group, split: whole groups are held out, so that test groups are unseen in training. Fewer than three are an error."""
    groups = rows.select(F.col(group_col).cast("string").alias("group")).distinct()
    placed = ranked(groups.withColumn("_all", F.lit(0)), ["_all"], seeded_hash(F.col("group"), seed))
    each = F.greatest(F.lit(1.0), F.bround(F.col("n") * F.lit(share)))
    split = F.when(F.col("rn") <= F.col("n") - 2 * each, "train").when(F.col("rn") <= F.col("n") - each, "validation").otherwise("test")
    checked = F.when(F.col("n") < 3, F.raise_error(F.lit("a split by groups needs at least three groups"))).otherwise(split) if strict else split
    return placed.select("group", checked.cast("string").alias("split"))


def merged(*parts: DataFrame, seed: int = 42) -> DataFrame:
    """The union of the sources' rows (id, source, split and more), with the hash that orders each split."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return union.withColumn("shuffle_key", seeded_hash(F.concat("split", F.lit(":"), F.col("id").cast("string")), seed))


def merge_shuffled(*parts: DataFrame, seed: int = 42) -> DataFrame:
    """merged() in its order: each split by its hashes."""
    return merged(*parts, seed=seed).orderBy("split", "shuffle_key")


def take_subset(df: DataFrame, limit: int | None, id_col: str, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most limit rows, in hash order; all rows without a limit."""
    if limit is None:
        return df
    if limit < 1:
        raise ValueError("a subset needs at least one row")
    return df.orderBy(seeded_hash(F.col(id_col), seed), id_col).limit(limit)


def leakage(assigned: DataFrame) -> DataFrame:
    """Documents that stand in more than one split; there should be none."""
    return assigned.groupBy("source", "document").agg(F.countDistinct("split").alias("splits")).where("splits > 1")
