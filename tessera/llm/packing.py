"""Packing of token ids by harmonic classes.

A document's ids are cut into pieces whose lengths lie just below 1/k of the capacity: whole
sequences first, then the rest goes to class k = capacity // length if that wastes at most 1/SLACK
of it, else the largest 1/k part that fits is cut off and the remainder is treated likewise. Every
bin of class k holds exactly k pieces, so bins are filled by numbering the pieces of a class: each
worker numbers its own bucket of pieces from an offset, and no worker waits for another. Buckets are dealt by
a hash with the row's number, so rows without an id or with one id do not meet; which pieces share a sequence follows the
order of the input's files. The pieces
beyond a class's last full bin, fewer than k for each class and so bounded by the capacity alone, are
packed first-fit by falling length at the end.

Defined results: a null text is an empty one and consists of the end id; pieces of rows with equal or
null doc_id are packed like others, and equal rows have equal pieces; an empty table gives an
empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tessera.llm.common import keep, partitions, small_batches, worker_cache

CAPACITY = 1024
SLACK = 64
#: The split pattern of byte-level BPE as the tokenizers library has it built in.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 bytes stand for themselves, others for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids as the tokenizers library gives them. Latin-1 texts without special tokens take a faster
    library's road over the same vocabulary if that is byte-level BPE with ids in merge order."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            raw = f.read()
        self.full, self.fast = Tokenizer.from_str(raw), None
        spec = json.loads(raw)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer"):
            return
        letters = _byte_letters()
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        order = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if any(c not in letters for t in vocab for c in t) or order != sorted(order) or len(set(vocab.values())) != len(vocab):
            return
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and (self.special is None or not self.special.search(text)):
            try:
                text.encode("latin-1")
                return self.fast.encode_ordinary(text)
            except UnicodeEncodeError:
                pass
        return self.full.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    """One encoder in each Python worker."""
    _encoders = worker_cache("packing")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(length, class) of the pieces of n ids."""
    out = [(capacity, 1)] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if capacity // k - n <= n // SLACK:
            out.append((n, k))
            break
        size = capacity // (k + 1)
        out.append((size, k + 1))
        n -= size
    return out


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids = np.array([*enc.ids(text or ""), end_id], "<u4")
                at = 0
                for size, k in cut(len(ids), capacity):
                    rows.append((doc_id, at, size, zlib.crc32(ids[at : at + size]), len(ids), k))
                    at += size
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def _first_fit(capacity: int):
    def run(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        used: list[int] = []
        where, at = [], []
        first = 0  # bins before it are full
        for size in rest["length"]:
            k = next((i for i in range(first, len(used)) if used[i] + size <= capacity), len(used))
            if k == len(used):
                used.append(0)
            where.append(k)
            at.append(used[k])
            used[k] += size
            while first < len(used) and used[first] == capacity:
                first += 1
        return rest.assign(sequence_id=where, offset=at)[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    source = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = source.mapInPandas(_pieces(path, end_id, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int")
    buckets = 4 * partitions(spark)
    bucket = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(buckets))
    pieces = keep(made.withColumn("bucket", bucket.cast("int")), "pieces")
    # as many rows as there are classes times buckets
    counts = pieces.groupBy("class", "bucket").count()
    totals = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("count").alias("n")).collect()}
    base, first = {}, 0
    for k in sorted(totals):
        base[k] = first
        first += totals[k] // k
    if not totals:
        return pieces.select(*out[:5], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    of_class = spark.createDataFrame([(k, base[k], totals[k] // k * k) for k in totals], "class int, base long, full long")
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("class", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    # an offset is a row of its own, the first one of its bucket and class: their number grows with the cluster, so it is not broadcast
    both = pieces.unionByName(offsets, allowMissingColumns=True).repartition(partitions(spark), "bucket")
    own = Window.partitionBy("bucket", "class").orderBy(F.col("before").isNull(), "doc_id", "start", "ids_crc32")
    numbered = (
        both.withColumn("number", F.row_number().over(own) - 2 + F.first("before").over(own))
        .where(F.col("before").isNull())
        .join(F.broadcast(of_class), "class")
    )
    in_bin = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        numbered.where("number < full")
        .withColumn("sequence_id", (F.col("base") + F.expr("number div class")).cast("long"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)).cast("long"))
    )
    shape = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    # fewer than k pieces of each class k, whatever the input
    rest = numbered.where("number >= full").select(*out[:5]).groupBy().applyInPandas(_first_fit(capacity), shape)
    return filled.select(*out).unionByName(rest.withColumn("sequence_id", F.col("sequence_id") + first))
