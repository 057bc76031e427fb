"""Sharding by minimax contiguous partition.

All rows whose texts have one 64-bit hash form an atomic group, so equal texts stay together. Groups are ordered by
that hash, but for the large ones (over 1 / SHARE of a shard, so at most SHARE for each shard): those are dealt
in turn, by falling size, to the beginnings of equal hash ranges, one for each shard, so that cuts tend to fall among small groups.
The smallest shard capacity that lets a greedy sweep cover the ordered groups with the
given number of shards is found by binary search, and the sequence is cut where that sweep cuts.

The sweep never sees single groups of the whole corpus. It works on segments of the hash order
(at most 2**LEVEL_BITS at first) and only segments that may hold a cut, a few for each shard, are
read again in finer segments until each is one group or holds no cut. What reaches the driver is bounded by the
number of segments and shards, not by the rows.

Defined results: a null text is an empty one and has size 1; rows with a null id are placed like
others; an empty table gives an empty result; repeated rows are separate rows of the same group;
columns other than id and text are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import keep, partitions

LEVEL_BITS = 14
SHARE = 256
SCHEMA = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


def greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """ends: prefix sums of the segments' sizes. The index after each shard's last segment, or None."""
    cuts, at = [], 0
    while at < len(ends):
        if len(cuts) == shards:
            return None
        nxt = bisect_right(ends, (ends[at - 1] if at else 0) + capacity)
        if nxt == at:
            return None
        cuts.append(at := nxt)
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the smallest capacity that greedy() finds feasible."""
    ends = list(accumulate(sizes))
    low, high = max(-(-ends[-1] // shards), max(sizes)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(ends, mid, shards) else (mid + 1, high)
    return low


def _reach(sizes: list[int], whole: list[bool], capacity: int, shards: int, divisible: bool) -> list[int]:
    """Byte positions of the cuts of a sweep that may (or may not) cut inside segments of many groups."""
    ends, at, out = list(accumulate(sizes)), 0, []
    for _ in range(shards):
        goal = at + capacity
        k = bisect_right(ends, goal)
        floor = max(ends[k - 1] if k else 0, at)
        at = goal if divisible and k < len(ends) and not whole[k] else floor
        out.append(min(at, ends[-1]))
    return out


def _segments(narrow: DataFrame, shift: int) -> list:
    """(segment number, first key, last key, bytes) in key order; as many rows as there are segments."""
    got = narrow.groupBy(F.shiftright("key", shift).alias("seg")).agg(F.min("key").alias("a"), F.max("key").alias("b"), F.sum("size").alias("n")).collect()
    return sorted((r["a"], r["b"], r["n"]) for r in got)


def cut_keys(narrow: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and the last key of each shard but the final one."""
    shift = 64 - LEVEL_BITS
    segments = _segments(narrow, shift)
    if not segments:
        return 0, []
    while True:
        sizes, whole = [s[2] for s in segments], [s[0] == s[1] for s in segments]
        total = sum(sizes)
        least = max([-(-total // shards), *(n for n, w in zip(sizes, whole) if w)])
        most = smallest_capacity(sizes, shards)
        early, late = _reach(sizes, whole, least, shards, False), _reach(sizes, whole, most, shards, True)
        ends, open_ = list(accumulate(sizes)), set()
        for a, b in zip(early, late):
            k = bisect_right(ends, a)
            while k < len(ends) and ends[k] - sizes[k] <= b:
                if not whole[k]:
                    open_.add(k)
                k += 1
        if not open_ or shift == 0:
            cuts = greedy(ends, most, shards)
            return most, [segments[c - 1][1] for c in cuts[:-1]]
        finer = max(0, shift - LEVEL_BITS)
        wanted = sorted({segments[k][0] >> shift for k in open_})
        part = _segments(narrow.where(F.shiftright("key", shift).isin(wanted)), finer)
        # segments of different widths stand side by side: a part replaces the open ones it covers
        opened = [segments[k] for k in sorted(open_)]
        part = [s for s in part if any(o[0] <= s[0] <= o[1] for o in opened[max(0, bisect_right(opened, (s[0], 1 << 63, 0)) - 1) :][:1])]
        segments = sorted([s for k, s in enumerate(segments) if k not in open_] + part)
        shift = finer


def in_order(narrow: DataFrame, shards: int) -> DataFrame:
    """narrow with key as the place of the row's group in the order."""
    total = narrow.agg(F.sum("size")).first()[0] or 0
    # groups of at least 1 / (SHARE * shards) of all bytes: there cannot be more than SHARE * shards of them
    least = max(1, -(-total // (SHARE * shards)))
    large = narrow.groupBy("key").agg(F.sum("size").alias("n")).where(F.col("n") >= least).collect()
    width = (1 << 64) // shards
    places = []
    for rank, r in enumerate(sorted(large, key=lambda r: (-r["n"], r["key"]))):
        turn, lane = divmod(rank, shards)
        lane = shards - 1 - lane if turn % 2 else lane
        places.append((r["key"], -(1 << 63) + lane * width + turn * (width // (32 * SHARE))))
    if not places:
        return narrow
    # built from a literal, in the JVM
    listed = F.from_json(F.lit(json.dumps([{"key": k, "place": p} for k, p in places])), "array<struct<key:bigint,place:bigint>>")
    moved = narrow.sparkSession.range(1).select(F.inline(listed))
    return narrow.join(F.broadcast(moved), "key", "left").withColumn("key", F.coalesce("place", "key")).drop("place")


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = keep(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-sizes",
    )
    narrow = in_order(narrow, shards)
    _, cuts = cut_keys(narrow, shards)
    number = sum([(F.col("key") > F.lit(c)).cast("int") for c in cuts], F.lit(0)).cast("int")
    # a shard is dealt to many tasks by a hash of the row; each part's first slot is a running sum of counts
    parts = max(64, 4 * partitions(spark))
    placed = narrow.withColumns({"shard": number, "part": F.pmod(F.xxhash64("doc_id", "key"), F.lit(parts)).cast("int")})
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "key")
    ranked = placed.withColumn("within", F.row_number().over(within) - 1)
    # at most shards * parts rows, whatever the input
    return ranked.join(F.broadcast(first), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
