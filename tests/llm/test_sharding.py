import random
import zlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from tessera.llm import sharding
from tessera.llm.sharding import greedy, shard, smallest_capacity


@given(st.lists(st.integers(1, 50), min_size=1, max_size=40), st.integers(1, 8))
def test_capacity_is_the_smallest(sizes, shards):
    from itertools import accumulate

    ends = list(accumulate(sizes))
    c = smallest_capacity(sizes, shards)
    assert greedy(ends, c, shards) is not None
    assert c == max(sizes) or c == -(-ends[-1] // shards) or greedy(ends, c - 1, shards) is None


def check(rows, got, shards):
    groups = defaultdict(set)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    wanted = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert wanted == sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got)


def test_minimax_over_the_hash_order(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LEVEL_BITS", 5)  # several levels of segments
    r = random.Random(2)
    rows = [(i, "x" * r.randrange(1, 90) + str(i % 400)) for i in range(1500)] + [(5000 + i, "hot text" * 9) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard(df, shards=7).collect()
    check(rows, got, 7)
    from pyspark.sql import functions as F

    narrow = df.select(F.xxhash64("text").alias("key"), (F.octet_length("text").cast("long") + 1).alias("size"))
    sized = sharding.in_order(narrow, 7).groupBy("key").agg(F.sum("size").alias("n")).orderBy("key").collect()
    load = defaultdict(int)
    for x in got:
        load[x["shard"]] += x["size"]
    assert max(load.values()) == smallest_capacity([x["n"] for x in sized], 7) == 700 * 73


def test_shards_are_even(spark):
    rows = [(i, "x" * (i * i % 5000)) for i in range(1200)]
    load = defaultdict(int)
    for x in shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect():
        load[x["shard"]] += x["size"]
    mean = sum(load.values()) / 8
    assert max(load.values()) < 1.01 * mean and min(load.values()) > 0.95 * mean


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(rows, shard(odd_docs).collect(), 16)
    assert shard(no_docs).count() == 0
