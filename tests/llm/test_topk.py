import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm.topk import LEAF, NEVER, bounds, build, search, top_k

SHAPE = "vec_id long, embedding array<float>, label int, shard int, v string"


def brute(rows, k, every):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[(i, tuple(v))] = [math.floor(64 * x) for x in v]
    out = {}
    for (q, _), a in good.items():
        if q % every == 0:
            hits = [(-sum(x * y for x, y in zip(a, b)), i) for (i, _), b in good.items() if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(hits)[:k]]
    return {q: v for q, v in out.items() if v}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_equals_brute_force_with_ties_nulls_and_copies(spark):
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)], 0, 1, "x") for i in range(700)]
    rows += [(i, [0.5] * 6, 0, 1, "x") for i in range(700, 1400)]  # one very common vector
    rows += [(2000, None, 0, 0, ""), (2020, [None, 1.0], 0, 0, ""), (2040, [float("nan")] * 6, 0, 0, ""), (2060, [float("inf")] + [0.0] * 5, 0, 0, ""), (2080, [], 0, 0, ""), (None, [1.0] * 6, 0, 0, ""), rows[0], (2100, [1.0, 2.0], 0, 0, "")]
    df = spark.createDataFrame(rows, SHAPE)
    assert found(top_k(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=200)) == brute(rows, 7, 20)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0], 0, 0, ""), (20, [2.0], 0, 0, ""), (3, [-1.0], 0, 0, "")]
    assert found(top_k(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 20 == 0)) == brute(rows, 20, 20)
    assert top_k(spark.createDataFrame([], SHAPE), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_stay_whole_numbers():
    points = np.array([[1 << 30, 3], [5, 7], [-(1 << 30), 1]], dtype=np.int64)
    ids = np.array([1, 2, 3])
    s, i = search(build(points.astype(float), ids), points, ids, points[:1], ids[:1], 2, np.array([-(1 << 63)]), np.array([1 << 62]))
    assert i[0].tolist() == [2, 3] and s[0].tolist() == [5 * (1 << 30) + 21, -(1 << 60) + 3]


def _flat(points, ids, q, qid, k):
    s = points @ q
    return sorted(((-int(x), int(i)) for x, i in zip(s, ids) if i != qid))[:k]


def _search(points, ids, k, seen=None):
    never, top = np.full(len(points), NEVER), np.full(len(points), (1 << 63) - 1)
    return search(build(points.astype(float), ids), points, ids, points, ids, k, never, top, seen)


def test_bounds_hold_and_prune_what_has_structure():
    r = np.random.default_rng(7)
    middles = r.normal(0, 60, (24, 16))
    points = np.floor(np.concatenate([c + r.normal(0, 2, (400, 16)) for c in middles])).astype(np.int64)
    points[::50] = points[0]  # ties
    points[7] = 0
    ids = r.permutation(len(points))
    tree = build(points.astype(float), ids)
    b = bounds(points[:50].astype(float), tree["centres"], tree["radii"], tree["norms"], tree["angles"])
    for leaf, path in zip(tree["leaves"], tree["paths"]):
        assert len(leaf) <= LEAF or (points[leaf] == points[leaf[0]]).all()
        assert (b[:, list(path)] >= (points[:50] @ points[leaf].T).max(axis=1)[:, None]).all()
    seen = []
    s, i = _search(points, ids, 9, seen)
    assert seen[0] < 0.5 * seen[1]
    for q in range(0, len(points), 97):
        assert [(-x, y) for x, y in zip(s[q].tolist(), i[q].tolist())] == _flat(points, ids, points[q], ids[q], 9)


def test_equals_brute_force_over_shards_and_blocks(spark, monkeypatch):
    from tessera.llm import topk

    monkeypatch.setattr(topk, "BLOCK_NUMBERS", 40)
    monkeypatch.setattr(topk, "CENTRES", 5)
    r = random.Random(6)
    middle = [[r.gauss(0, 3) for _ in range(4)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + r.gauss(0, 0.2))) for x in middle[i % 6]], 0, 1, "x") for i in range(900)]
    rows += [(i, [0.0] * 4, 0, 1, "x") for i in range(900, 1000)]
    assert found(top_k(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 20 == 0, k=7, shard_rows=64)) == brute(rows, 7, 20)
