"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Text is folded first: lower case, compatibility forms, look-alike letters of other alphabets (in words that mix them
with Latin letters, and in words of nothing else within a Latin text), and
digits or signs that stand for letters between letters. The folded words are joined by single
spaces, so terms are whole words (" idiot ") or beginnings of words (" achlich"). At each
word the longest term counts, unless an exception phrase covers it. The score is a logistic
function of the hits' summed weights, alone and by the length of the text.

The lexicon, the exceptions and the function's coefficients are learned from a bounded sample of
labelled rows: `rows_per_class` rows of each label by a hash of the id, at most `most_terms` terms.
A term's weight is its log odds over documents. Coefficients are fitted on features that were
computed with a lexicon from the other half of the sample.

Defined results: null and empty texts and texts without words get the score of a text without hits;
a doc_id with several labels counts as toxic if any says so; without labels of both classes every
score is 0; columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import held_out, keep, learnable, place, sample_limits, small_batches, worker_cache

# Letters of other alphabets that look like Latin ones, and signs used for letters.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
_LOOK = str.maketrans(LOOK_ALIKE)
#: Signs count between letters, digits also at a word's ends.
_SIGN = re.compile(r"(?<=[^\W\d_])[0134578@$!|9]+(?=[^\W\d_])|(?<=[^\W\d_])[01345789]+|[01345789]+(?=[^\W\d_])")
_SIGNS = str.maketrans(SIGNS)
_WORD = re.compile(r"[^\W\d_]+")
HIDDEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
#: translate() is slow, and few texts need it.
_LOOKS, _HIDES = (re.compile("[" + "".join(map(re.escape, x)) + "]") for x in (LOOK_ALIKE, map(chr, HIDDEN)))
_RUN = re.compile(r"[\w@$!|]+")
_LATIN, _ANY = re.compile("[a-z]"), re.compile(r"[^\W\d_]")
PREFIX = range(4, 9)


def _unmasked(text: str) -> str:
    """Look-alikes as the letters they stand for; words of another script stay as they are."""
    latin = 2 * len(_LATIN.findall(text)) > len(_ANY.findall(text))

    def one(m: re.Match) -> str:
        run = m[0]
        foreign = _LATIN.search(run) is None and not (latin and all(c in LOOK_ALIKE for c in _ANY.findall(run)))
        return run if foreign else run.translate(_LOOK)

    return _RUN.sub(one, text)


def words_of(text: str) -> list[str]:
    """The folded words of a text."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(HIDDEN) if _HIDES.search(text) else text).lower()
        text = _unmasked(text) if _LOOKS.search(text) else text
    return _WORD.findall(_SIGN.sub(lambda m: m[0].translate(_SIGNS), text))


def terms_of(words: list[str]) -> set[str]:
    """All terms a text could match: its words and their beginnings."""
    own = set(words)
    return {f" {w} " for w in own} | {f" {w[:n]}" for w in own for n in PREFIX if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, ...] = ()


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.coefficients = lexicon.coefficients
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights:
            self.automaton.add_word(term, (len(term), weight, term))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None, phrase))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float, str]]:
        """(start, weight, term): the longest term at each word, without those that an exception covers."""
        if not len(self.automaton):
            return []
        longest: dict[int, tuple[int, float, str]] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, term) in self.automaton.iter(folded):
            start = end + 1 - size
            if weight is None:
                spared.append((start, end))
            elif start not in longest or longest[start][0] < size:
                longest[start] = (size, weight, term)
        if spared:
            covered, at = set(), -1
            for a, b in sorted(spared):
                covered.update(range(max(a, at), b))
                at = max(at, b)
            longest = {s: x for s, x in longest.items() if s not in covered}
        return [(s, w, t) for s, (_, w, t) in longest.items()]

    def features(self, text: str) -> tuple[float, float, float]:
        """Summed weights (damped), summed weights for a hundred words (damped), length (damped)."""
        words = words_of(text)
        total = sum(w for _, w, _ in self.hits(f" {' '.join(words)} "))
        n = len(words)
        return math.log1p(max(total, 0.0)), math.log1p(100 * max(total, 0.0) / (n + 20)), math.log1p(n)

    def score(self, text: str) -> float:
        if not self.coefficients:
            return 0.0
        z = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _weights(counts: list, most: int, n: tuple[int, int]) -> tuple[tuple[str, float], ...]:
    """The terms that tell most, with their log odds. counts: (term, toxic rows, clean rows); n: all rows of each."""
    out = []
    for term, a, b in counts:
        if a < max(3, 0.004 * n[0]):
            continue
        weight = math.log((a + 0.5) / (n[0] + 1)) - math.log((b + 0.5) / (n[1] + 1))
        gain = a - n[0] * (a + b) / (n[0] + n[1])
        if weight > 1.5 and gain * gain > 9 * (a + b) * n[0] * n[1] / (n[0] + n[1]) ** 2:
            out.append((gain * weight, term, weight))
    return tuple((t, w) for _, t, w in sorted(out, key=lambda x: (-x[0], x[1]))[:most])


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small ridge."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [1e-2] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge + 1e-6 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, rows_per_class: int = 2500, most_terms: int = 3000, given_exceptions: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """A lexicon from the bounded sample; what reaches the driver is bounded by the parameters."""
    by_hash = Window.partitionBy("y").orderBy("h", "id")
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("y").isNotNull() & learnable(F.col("id")))
        .groupBy("id").agg(F.max("y").alias("y"))
        .withColumn("h", place(F.col("id")))
    )
    limits = sample_limits({r["y"]: r["count"] for r in known.where("y in (0, 1)").groupBy("y").count().collect()}, rows_per_class)
    few = F.when(F.col("y") == 1, F.lit(limits.get(1, 0))).when(F.col("y") == 0, F.lit(limits.get(0, 0)))
    rows = known.where(F.col("h") < few).withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= rows_per_class).select("id", "y", F.col("h").bitwiseAND(1).cast("int").alias("half"))
    # at most 2 * rows_per_class ids
    sample = keep(small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(rows), "id").select("y", "half", "text"), "toxicity-sample")
    sizes = {(r["half"], r["y"]): r["n"] for r in sample.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [(sizes.get((h, 1), 0), sizes.get((h, 0), 0)) for h in (0, 1)]
    both = (n[0][0] + n[1][0], n[0][1] + n[1][1])
    if not both[0] or not both[1]:
        return Lexicon(())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: list[Counter] = [Counter() for _ in range(4)]
        for b in batches:
            for y, half, text in zip(b["y"], b["half"], b["text"]):
                seen[2 * half + (y == 0)].update(terms_of(words_of(text)))
        for k, c in enumerate(seen):
            if c:
                yield pd.DataFrame({"term": list(c), "k": k, "n": list(c.values())})

    # spread the sample over tasks by content, as its rows may lie in few files
    spread = sample.repartition(16, "text")
    counted = spread.mapInPandas(count, "term string, k int, n long").groupBy("term").agg(*[F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(4)])
    toxic, clean = F.col("c0") + F.col("c2"), F.col("c1") + F.col("c3")
    found = counted.where((toxic >= 3) & (toxic * both[1] > clean * both[0] * 2)).orderBy(F.desc(toxic - clean * (both[0] / both[1])), "term").limit(8 * most_terms).collect()
    half_lexicons = [Lexicon(_weights([(r["term"], r[f"c{2 * h}"], r[f"c{2 * h + 1}"]) for r in found], most_terms, n[h])) for h in (0, 1)]
    weights = _weights([(r["term"], r["c0"] + r["c2"], r["c1"] + r["c3"]) for r in found], most_terms, both)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = [Matcher(half_lexicons[1]), Matcher(half_lexicons[0])]
        for b in batches:
            yield pd.DataFrame([(y, *matchers[half].features(text)) for y, half, text in zip(b["y"], b["half"], b["text"])], columns=["y", "a", "b", "c"])

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, seen = Matcher(Lexicon(weights)), Counter()
        for b in batches:
            for y, text in zip(b["y"], b["text"]):
                folded = f" {' '.join(words_of(text))} "
                around: set[str] = set()
                for start, _, _ in matcher.hits(folded):
                    stop = folded.index(" ", start + 1)
                    after = folded.find(" ", stop + 1)
                    before = folded.rfind(" ", 0, start)
                    around |= {folded[start : after + 1]} if after > 0 else set()
                    around |= {folded[before : stop + 1]} if before >= 0 else set()
                seen.update((p, y) for p in around)
        if seen:
            yield pd.DataFrame([(p, y, k) for (p, y), k in seen.items()], columns=["phrase", "y", "n"])

    x = np.array([tuple(r) for r in spread.mapInPandas(measure, "y int, a double, b double, c double").collect()], float)
    around = spread.mapInPandas(phrases, "phrase string, y int, n long").groupBy("phrase").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c"))
    # a phrase around a term that clean rows hold and toxic ones hardly do
    spared = around.where((F.col("c") >= 4) & (F.col("t") * 8 < F.col("c"))).orderBy(F.desc("c"), "phrase").limit(most_terms).collect()
    return Lexicon(weights, tuple(sorted({r["phrase"] for r in spared} | set(given_exceptions))), _fit(x[:, 1:], x[:, 0]))


def matcher(lexicon: Lexicon) -> Matcher:
    """One matcher in each Python worker."""
    _matchers = worker_cache("toxicity")
    if lexicon not in _matchers:
        _matchers.clear()
        _matchers[lexicon] = Matcher(lexicon)
    return _matchers[lexicon]


def score_column(lexicon: Lexicon, text_col: str = "text"):
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = matcher(lexicon)
        for texts in batches:
            yield pd.Series([m.score(t or "") for t in texts], dtype="float64")

    return score(F.col(text_col))


def toxicity_query(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    lexicon = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
