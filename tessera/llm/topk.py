"""Exact top-k by inner product: a ball tree in each shard, searched by branch and bound.

Vectors are dealt to shards by the nearest of a few centres that a bounded sample gives, so that a shard is a ball of its
own; a centre with many vectors (one very common vector, say) has several shards, dealt by a hash of the id.
Each shard's tree is searched for blocks of queries. A node's bound for query q is the smaller one of
q . centre + |q| * radius and |q| * (largest norm) * cos(angle to the centre - widest angle in the node);
leaves are visited in the order of the smallest bound on their path,
and a leaf is skipped once its bound cannot beat the current kth (score, id).

Two rounds share the kth score between shards: first each query searches the shard its own row
falls into; then every other shard that its centre's bound leaves open gets the query together with the kth score found so
far, and returns only rows that can still enter the result. Shards and blocks of queries are as large as memory allows, as
the vectors that move are queries times shards plus rows times blocks.

Vectors without any structure, such as random ones of many dimensions, leave no bound below the kth score; then all
products are computed, as by a flat search.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part,
nor do rows without an id; repeated rows with equal id and vector count once; rows with the
query's id are never its candidates; only vectors of equal length are compared; with fewer than k
candidates all are returned; an empty table gives an empty result. Scores are 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import keep, small_batches

LEAF = 1024
#: Numbers (not rows) in a shard and in a block of queries.
SHARD_NUMBERS = BLOCK_NUMBERS = 1 << 22
#: Centres, and vectors of the sample that gives them.
CENTRES, SAMPLE = 256, 4096
#: Below this, products of whole numbers are exact in double precision, and leave room for a place in a leaf.
EXACT = float(1 << 52)
NEVER = -(1 << 63)


def build(points: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray | list]:
    """A ball tree as arrays: centres, radii, norms, widest angles and smallest ids of nodes, each leaf's rows and path."""
    centres, radii, norms, angles, least, leaves, paths = [], [], [], [], [], [], []
    norm = np.sqrt((points**2).sum(axis=1))
    stack: list[tuple[np.ndarray, tuple[int, ...]]] = [(np.arange(len(points)), ())]
    while stack:
        rows, path = stack.pop()
        p = points[rows]
        c = p.mean(axis=0)
        away = np.sqrt(((p - c) ** 2).sum(axis=1))
        here = (*path, len(centres))
        centres.append(c)
        radii.append(away.max())
        norms.append(norm[rows].max())
        angles.append(_angle(p @ c, norm[rows] * np.sqrt(c @ c)).max())
        least.append(ids[rows].min())
        if len(rows) <= LEAF or away.max() == 0:
            # equal points: one long leaf in the order of ids, of which the first k matter to any query
            leaves.append(rows[np.argsort(ids[rows], kind="stable")])
            paths.append(here)
            continue
        a = p[away.argmax()]
        b = p[((p - a) ** 2).sum(axis=1).argmax()]
        side = p @ (b - a)
        order = np.argsort(side, kind="stable")
        half = len(rows) // 2
        stack += [(rows[order[:half]], here), (rows[order[half:]], here)]
    return {"centres": np.array(centres), "radii": np.array(radii), "norms": np.array(norms), "angles": np.array(angles), "least": np.array(least), "leaves": leaves, "paths": paths}


def _angle(products: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Angles from inner products and products of norms; a zero vector lies at any angle, so at the widest one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, np.arccos(np.clip(products / lengths, -1, 1)), np.pi)


def bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> np.ndarray:
    """(query x node) upper bounds of the inner products, a little above for rounding."""
    length, size = np.sqrt((q**2).sum(axis=1))[:, None], np.sqrt((centres**2).sum(axis=1))
    inner = q @ centres.T
    ball = inner + length * radii
    cone = length * norms * np.cos(np.maximum(_angle(inner, length * size) - angles - 1e-7, 0))
    # a zero centre has no direction, and a cone's bound below zero holds for the largest norm only
    cone = np.where((size > 0) & (cone >= 0), cone, length * norms)
    return np.minimum(ball, cone) + 1e-9 * length * (size + radii + norms) + 1e-6


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    if np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, by falling score and rising id; ids are one row for all or one for each."""
    first = np.argsort(ids, axis=-1, kind="stable")
    s, i = (scores[:, first], np.broadcast_to(ids[first], scores.shape)) if ids.ndim == 1 else (np.take_along_axis(scores, first, 1), np.take_along_axis(ids, first, 1))
    # numpy has no descending stable sort; ~s reverses the order of 64-bit integers without overflow
    best = np.argsort(~s, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)


def _leaf_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """_best() of a leaf whose ids rise. Score and place in the leaf in one number can be partitioned instead of sorted."""
    n = len(ids)
    if n <= 2 * k or n > LEAF or max(abs(int(scores.max())), abs(int(np.where(scores == NEVER, 0, scores).min()))) >= EXACT:
        return _best(scores, ids, k)
    gone = scores == NEVER
    key = np.where(gone, NEVER, (scores << 10) | (LEAF - 1 - np.arange(n)))
    at = np.argpartition(key, n - k, axis=1)[:, n - k :]
    return np.take_along_axis(scores, at, 1), ids[at]


def search(tree: dict, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, known: np.ndarray, known_id: np.ndarray, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (NEVER where there is none) of each query's k best, worse than (known, known_id) left out at will.

    seen: the numbers of products computed and of products in all are added to it.
    """
    m = len(queries)
    top, top_id = np.full((m, k), NEVER), np.full((m, k), np.iinfo(np.int64).max)
    bound = bounds(queries.astype(np.float64), tree["centres"], tree["radii"], tree["norms"], tree["angles"])
    leaf_bound = np.stack([bound[:, list(path)].min(axis=1) for path in tree["paths"]], axis=1)
    leaf_least = np.array([tree["least"][path[-1]] for path in tree["paths"]])
    order = np.argsort(-leaf_bound, axis=1, kind="stable")
    active = np.arange(m)
    done = 0
    for turn in range(order.shape[1]):
        leaf = order[active, turn]
        at = np.floor(leaf_bound[active, leaf])
        kth, kth_id = top[active, -1], top_id[active, -1]
        better = (known[active] > kth) | ((known[active] == kth) & (known_id[active] < kth_id))
        kth, kth_id = np.where(better, known[active], kth), np.where(better, known_id[active], kth_id)
        # bounds only fall from here, so a query below its kth score is done; at a tie a smaller id may still win
        going = (kth == NEVER) | (at >= kth)
        use = going & ((kth == NEVER) | (at > kth) | (leaf_least[leaf] <= kth_id))
        for x in np.unique(leaf[use]):
            some = use & (leaf == x)
            rows = active[some]
            here = tree["leaves"][x]
            if len(here) > LEAF:  # equal points: ids beyond the first k + 1 lose every tie
                here = here[: k + 1]
            got = _products(queries[rows], points[here])
            done += got.size
            got[query_ids[rows][:, None] == ids[here][None, :]] = NEVER
            # most leaves have nothing for most queries
            may = got.max(axis=1) >= kth[some]
            if may.any():
                rows = rows[may]
                s, i = _leaf_best(got[may], ids[here], k)
                top[rows], top_id[rows] = _best(np.concatenate([top[rows], s], axis=1), np.concatenate([top_id[rows], i], axis=1), k)
        active = active[going]
        if not len(active):
            break
    if seen is not None:
        seen += [done, m * len(points)]
    return top, top_id


def _shard_search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(cand: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(cand) and len(asked):
            sizes = cand["v"].map(len)
            for d in asked["asked_v"].map(len).unique():
                own = cand[sizes == d]
                if not len(own):
                    continue
                own = own.assign(key=own["v"].map(lambda v: v.tobytes())).drop_duplicates(["vec_id", "key"])
                points, ids = np.stack(own["v"].to_numpy()), own["vec_id"].to_numpy(np.int64)
                tree = build(points.astype(np.float64), ids)
                mine = asked[asked["asked_v"].map(len) == d]
                for start in range(0, len(mine), 512):
                    part = mine.iloc[start : start + 512]
                    qid = part["query_id"].to_numpy(np.int64)
                    known, known_id = part["known"].to_numpy(np.int64), part["known_id"].to_numpy(np.int64)
                    s, i = search(tree, points, ids, np.stack(part["asked_v"].to_numpy()), qid, k, known, known_id)
                    keep_ = (s != NEVER) & ((s > known[:, None]) | ((s == known[:, None]) & (i <= known_id[:, None])))
                    row, _ = np.nonzero(keep_)
                    out.append(pd.DataFrame({"query_id": qid[row], "vec_id": i[keep_], "score": s[keep_]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return run


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of a sample by a few rounds of k-means from its first distinct rows."""
    centres = np.unique(sample, axis=0, return_index=True)[1]
    centres = sample[np.sort(centres)[:count]].astype(np.float64)
    for _ in range(5):
        near = _nearest(sample, centres)
        centres = np.stack([sample[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * (points @ centres.T)).argmin(axis=1)


def _place(centres: np.ndarray):
    """The nearest centre of a vector, and its distance to it, norm and angle. -1: a vector of another length."""

    @F.pandas_udf("centre int, away double, norm double, angle double")
    def run(vectors: pd.Series) -> pd.DataFrame:
        out = np.zeros((4, len(vectors)))
        out[0] = -1
        same = np.flatnonzero(vectors.map(len).to_numpy() == centres.shape[1])
        if len(same):
            p = np.stack(vectors.iloc[same].to_numpy()).astype(np.float64)
            near = _nearest(p, centres)
            c, norm = centres[near], np.sqrt((p**2).sum(axis=1))
            out[:, same] = near, np.sqrt(((p - c) ** 2).sum(axis=1)), norm, _angle((p * c).sum(axis=1), norm * np.sqrt((c**2).sum(axis=1)))
        return pd.DataFrame({"centre": out[0].astype(np.int32), "away": out[1], "norm": out[2], "angle": out[3]})

    return run


def _open_shards(centres: np.ndarray, balls: dict[int, tuple[float, float, float]], shards: dict[int, tuple[int, int]]):
    """The shards that a query's bounds leave open, but for its own. shards: the first shard of a centre and their number."""
    known_centres = sorted(c for c in balls if c >= 0)
    radii, norms, angles = (np.array([balls[c][k] for c in known_centres]) for k in range(3))
    other = [x for c in shards if c < 0 for x in range(shards[c][0], sum(shards[c]))]

    @F.pandas_udf("array<int>")
    def run(vectors: pd.Series, known: pd.Series, home: pd.Series) -> pd.Series:
        out: list[list[int]] = [list(other) for _ in range(len(vectors))]
        same = np.flatnonzero(vectors.map(len).to_numpy() == centres.shape[1])
        if len(same) and known_centres:
            q = np.stack(vectors.iloc[same].to_numpy()).astype(np.float64)
            may = np.floor(bounds(q, centres[known_centres], radii, norms, angles)) >= known.to_numpy()[same][:, None]
            for row, on in zip(same, may):
                out[row] = [x for c, use in zip(known_centres, on) if use for x in range(shards[c][0], sum(shards[c]))]
        return pd.Series([[x for x in xs if x != h] for xs, h in zip(out, home)])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best other rows by inner product of floor(scale * x)."""
    v = F.col(vector_col)
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    whole = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asked"), good.alias("good"))
        .where(F.col("vec_id").isNotNull() & F.coalesce("good", F.lit(False)))
        .select("vec_id", "asked", F.transform("raw", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))
    )
    n, m, size = whole.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asked").cast("long")), F.lit(0)), F.coalesce(F.mode(F.size("v")), F.lit(1))).first()
    most = shard_rows or max(1, SHARD_NUMBERS // size)
    wanted = max(1, math.ceil(n / most), min(16, math.ceil(n / 512)))
    blocks = max(1, math.ceil(m * size / BLOCK_NUMBERS))
    sample = whole.where(F.size("v") == size).select("v", F.xxhash64("vec_id").alias("h")).orderBy("h", "v").limit(SAMPLE).toPandas()["v"]
    centres = _centres(np.stack(sample.to_numpy()).astype(np.float64), min(CENTRES, wanted)) if n else np.zeros((1, size))
    placed = keep(small_batches(whole).withColumn("p", _place(centres)("v")).select("vec_id", "asked", "v", "p.centre", "p.away", "p.norm", "p.angle"), "top-k-vectors")
    # as many rows as there are centres
    balls = {r["centre"]: r for r in placed.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away"), F.max("norm").alias("norm"), F.max("angle").alias("angle")).collect()}
    shards, first = {}, 0
    for c in sorted(balls):
        shards[c] = (first, max(1, math.ceil(balls[c]["n"] * wanted / n)))
        first += shards[c][1]
    run = _shard_search(k)
    shape = "query_id long, vec_id long, score long"
    of = lambda at: F.element_at(F.create_map(*[F.lit(x) for c, s in (shards or {0: (0, 1)}).items() for x in (c, s[at])]), F.col("centre"))
    dealt = placed.select("vec_id", "asked", "v", (of(0) + F.pmod(F.xxhash64("vec_id"), of(1))).cast("int").alias("shard"))
    asked = dealt.where("asked").dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), F.col("v").alias("asked_v"), F.col("shard").alias("home"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    cand = dealt.select("shard", "vec_id", "v").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def shard_round(q: DataFrame) -> DataFrame:
        return cand.groupBy("shard", "block").cogroup(q.groupBy("shard", "block")).applyInPandas(run, shape)

    none = {"known": F.lit(NEVER).cast("long"), "known_id": F.lit((1 << 63) - 1).cast("long")}
    at_home = keep(shard_round(asked.withColumn("shard", F.col("home")).withColumns(none)), "top-k-home")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = at_home.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("query_id", F.col("score").alias("known"), F.col("vec_id").alias("known_id"))
    visits = _open_shards(centres, {c: (r["away"], r["norm"], r["angle"]) for c, r in balls.items()}, shards)
    others = (
        asked.join(kth, "query_id", "left")
        .fillna({"known": NEVER, "known_id": (1 << 63) - 1})
        .withColumn("shard", F.explode(visits("asked_v", "known", "home")))
    )
    found = at_home.unionByName(shard_round(others)) if first > 1 else at_home
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
