"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built from a bounded sample of labelled text. A text is
parsed against each automaton from left to right into longest matches; the language that needs the
fewest phrases for a character wins.

Every letter of the sample is a symbol of its own, so scripts with thousands of letters are told apart; an automaton
is a sparse table (a double array) that grows with its transitions only. Texts are parsed in lanes: all chunks
of a batch of whole texts take one symbol at a time side by side, as if a text began with each. Then
the parse that reaches the end of a chunk is carried on into the next one until it meets the state found there
before, from where on both are the same. So a text's phrases are those of one parse from its beginning to its end.

Learning is bounded: `rows_per_language` labelled rows with a letter for each language (fewer where that is more than
`most_rows` for all languages together, but 8 at least), chosen by a hash of the id,
short ones only after all others, and of each an excerpt of `chars_per_row` characters; the languages are all those among learnable
rows. Work grows with their number.

Defined results: a null or empty text, or one without a letter, gets 'und' and score 0; equal phrase
counts go to the language that comes first in alphabetical order; without learnable rows every
text gets 'und'; columns other than id, text and lang are ignored. The score is the winner's share
of exp(-phrases * SHARPNESS) over the languages, 1 / languages at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import fresh, held_out, learnable, place, sample_limits, small_batches, worker_cache

LANE = 128
SHARPNESS = 0.5
#: Texts of fewer characters are learned from only where a language has too few others.
LONG = 40
LETTER = r"\p{L}"
#: Symbols: 0 a gap (anything but letters), 1 a letter that no sample has, then the samples' letters; the last is padding.
GAP, OTHER = 0, 1


class Alphabet:
    """Maps code points to symbols, from the letters of the learning texts."""

    def __init__(self, texts: list[str]) -> None:
        seen = {c for t in texts for c in t if c.isalpha()}
        lower = {c: c.lower() if len(c.lower()) == 1 else c for c in seen}
        letters = sorted(set(lower.values()))
        self.size = len(letters) + 2
        self.table = np.zeros(0x110000, np.int32)
        self.table[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
        for k, c in enumerate(letters):
            for x in {c, c.upper()} if len(c.upper()) == 1 else {c}:
                self.table[ord(x)] = k + 2
        for c, low in lower.items():
            self.table[ord(c)] = self.table[ord(low)]

    def codes(self, text: str) -> np.ndarray:
        """The text's symbols, runs of gaps as one, without gaps at the ends."""
        got = self.table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        gap = got == GAP
        got = got[~(gap & np.r_[True, gap[:-1]])]
        return got[:-1] if len(got) and got[-1] == GAP else got


class Automaton:
    """A suffix automaton as a double array: state + symbol is the place of a transition, which holds its owner and the next
    state. A symbol without a transition ends a phrase; start has the state after a new start."""

    def __init__(self, nxt: list[dict[int, int]], size: int) -> None:
        counts = np.array([len(x) for x in nxt])
        first = np.cumsum(counts) - counts
        symbols = np.fromiter((c for x in nxt for c in x), np.int64, counts.sum())
        targets = np.fromiter((t for x in nxt for t in x.values()), np.int64, counts.sum())
        places = size + int(2.5 * max(len(nxt), len(targets)))
        used, taken = np.zeros(places + size + 1, bool), np.zeros(places, bool)
        at = np.zeros(len(nxt), np.int64)  # a state's number in the array; the root's is 0
        used[symbols[: counts[0]]] = taken[0] = True
        random = np.random.default_rng(0)
        # the states with most transitions come first; all states of a size are placed side by side until each fits
        for n in np.unique(counts[1:])[::-1]:
            left = 1 + np.flatnonzero(counts[1:] == n)
            while len(left):
                base = random.integers(1, places, len(left))
                where = base[:, None] + symbols[first[left, None] + np.arange(n)]
                fits = ~taken[base] & ~used[where].any(axis=1)
                fits &= np.isin(np.arange(len(base)), np.unique(base, return_index=True)[1])
                # of those that want the same place the first one gets it
                rows = np.flatnonzero(fits)
                owner = np.full(len(used), len(base))
                np.minimum.at(owner, where[rows].ravel(), np.repeat(rows, n))
                rows = rows[(owner[where[rows]] == rows[:, None]).all(axis=1)]
                at[left[rows]] = base[rows]
                taken[base[rows]] = True
                used[where[rows].ravel()] = True
                left = np.delete(left, rows)
        where = np.repeat(at, counts) + symbols
        self.owner, self.next = np.full(len(used), -1, np.int32), np.zeros(len(used), np.int32)
        self.owner[where], self.next[where] = np.repeat(at, counts), at[targets]
        self.start = np.zeros(size + 1, np.int32)
        for c, t in nxt[0].items():
            self.start[c] = at[t]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase went on."""
        where = state + symbol
        on = self.owner[where] == state
        return np.where(on, self.next[where], self.start[symbol]), on

    def __getitem__(self, at: tuple[int, int]) -> int:
        """The next state, or -(state after a new start) - 1 where a phrase ends."""
        where = at[0] + at[1]
        return int(self.next[where]) if self.owner[where] == at[0] else -int(self.start[at[1]]) - 1


def automaton(codes: list[int], size: int) -> Automaton:
    """The suffix automaton of a sample."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return Automaton(nxt, size)


class Parser:
    """The automata of all languages."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        self.alphabet = Alphabet([t for x in samples.values() for t in x])
        self.automata = []
        for lang in self.languages:
            parts = [c for t in samples[lang] if len(c := self.alphabet.codes(t))]
            codes = [x for c in parts for x in (*c.tolist(), GAP)]
            self.automata.append(automaton(codes, self.alphabet.size))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text x language) phrase counts and the number of symbols of each text."""
        codes = [self.alphabet.codes(t) for t in texts]
        sizes = np.array([len(c) for c in codes])
        lanes = -(-sizes // LANE)
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        total = int(lanes.sum())
        if not total:
            return counts, sizes
        grid = np.full(total * LANE, self.alphabet.size, np.int32)
        first = np.cumsum(lanes) - lanes
        for c, f in zip(codes, first):
            grid[f * LANE : f * LANE + len(c)] = c
        grid = np.ascontiguousarray(grid.reshape(total, LANE).T)
        owner = np.repeat(np.arange(len(texts)), lanes)
        # a lane's predecessor in its text; its padding stands at its end and has no transitions
        follows = np.r_[False, owner[1:] == owner[:-1]]
        padding = (grid == self.alphabet.size).sum(axis=0)
        for k, known in enumerate(self.automata):
            counts[:, k] = (lanes > 0) + np.bincount(owner, weights=self._breaks(known, grid, follows) - padding, minlength=len(texts)).astype(np.int64)
        return counts, sizes

    @staticmethod
    def _breaks(known: Automaton, grid: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """How often a phrase ends in each lane, padding included, in the parses of whole texts."""
        states, ends = np.zeros(grid.shape, np.int32), np.zeros(grid.shape, bool)
        state = np.zeros(grid.shape[1], np.int32)
        for row, column in enumerate(grid):
            state, on = known.step(state, column)
            states[row], ends[row] = state, ~on
        change = np.zeros(grid.shape[1], np.int64)
        last = state.copy()
        todo = np.flatnonzero(follows)
        while len(todo):
            # the parse that comes in from the lane before, until it meets this lane's
            at, state, found, out = np.arange(len(todo)), last[todo - 1], np.zeros(len(todo), np.int64), states[-1, todo].copy()
            for row, column in enumerate(grid):
                lane = todo[at]
                state, on = known.step(state, column[lane])
                found[at] += (~on).astype(np.int64) - ends[row, lane]
                apart = state != states[row, lane]
                at, state = at[apart], state[apart]
                if not len(at):
                    break
            out[at] = state
            change[todo] = found
            moved = todo[out != last[todo]]
            last[todo] = out
            # lanes whose predecessor ends otherwise than it was taken to
            todo = moved[(moved + 1 < len(follows))] + 1
            todo = todo[follows[todo]]
        return ends.sum(axis=0) + change

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        counts, sizes = self.phrases(texts)
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        best = counts.argmin(axis=1)
        share = 1 / np.exp(-SHARPNESS * (counts - counts.min(axis=1, keepdims=True))).sum(axis=1)
        return [self.languages[b] if n else "und" for b, n in zip(best, sizes)], [float(s) if n else 0.0 for s, n in zip(share, sizes)]


def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    """One parser in each Python worker, built from the sample."""
    _parsers = worker_cache("language")
    if samples not in _parsers:
        _parsers.clear()
        by: dict[str, list[str]] = {}
        for lang, text in samples:
            by.setdefault(lang, []).append(text)
        _parsers[samples] = Parser(by)
    return _parsers[samples]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 128, chars_per_row: int = 240, most_rows: int = 10_000) -> tuple[tuple[str, str], ...]:
    """The bounded sample: (language, excerpt) pairs from rows that may be learned from."""
    order = Window.partitionBy("lang").orderBy("short", "h", "id")
    lang = F.col(lang_col).cast("string")
    known = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang"), place(F.col(id_col)).alias("h"))
        .where(lang.isNotNull() & learnable(F.col(id_col)) & F.col("text").rlike(LETTER))
        .withColumn("short", F.length("text") < LONG)
    )
    sizes = known.groupBy("lang").agg(F.count_if(~F.col("short")).alias("long"), F.count_if(F.col("short")).alias("short")).orderBy("lang").collect()
    if not sizes:
        return ()
    rows_per_language = max(8, min(rows_per_language, most_rows // len(sizes)))
    # twice the rows wanted; short ones only where there are too few others
    few = {r["lang"]: r["short"] for r in sizes if r["long"] < rows_per_language}
    limits = {False: sample_limits({r["lang"]: r["long"] for r in sizes}, 2 * rows_per_language), True: {r["lang"]: 0 for r in sizes} | sample_limits(few, 2 * rows_per_language)}
    below = lambda short: F.try_element_at(F.create_map(*[x for k, v in limits[short].items() for x in (F.lit(k), F.lit(v).cast("long"))]), F.col("lang"))
    rows = (
        known.where(F.col("h") < F.when(F.col("short"), below(True)).otherwise(below(False)))
        # an excerpt's place in its text follows the hash of the id; only excerpts are moved
        .select("lang", "short", "h", "id", F.substring("text", F.lit(1) + F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - chars_per_row)).cast("int"), F.lit(chars_per_row)).alias("excerpt"))
        .withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= rows_per_language)
    )
    got = rows.select("lang", "r", "excerpt").orderBy("lang", "r").collect()
    return tuple((r["lang"], r["excerpt"]) for r in got)


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """docs with two more columns: the predicted language and its score."""

    @F.pandas_udf(f"{lang_out} string, {score_out} double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(samples)
        for texts in batches:
            langs, scores = [], []
            # about a million characters at a time, however long the texts are
            part, size = [], 0
            for t in [*texts, None]:
                part.append(t or "")
                size += len(part[-1])
                if size > 1_000_000:
                    a, b = parser.predict(part)
                    langs, scores, part, size = langs + a, scores + b, [], 0
            a, b = parser.predict(part)
            langs, scores = (langs + a)[: len(texts)], (scores + b)[: len(texts)]
            yield pd.DataFrame({lang_out: langs, score_out: scores})

    (found,) = fresh(docs, "identified")
    return small_batches(docs).withColumn(found, predict(F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{found}.{lang_out}"), F.col(f"{found}.{score_out}"))


def language_query(docs: DataFrame) -> DataFrame:
    samples = learn(docs)
    found = identify(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
