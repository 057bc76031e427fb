"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

In the BPE encoding of a text, the tokens of any prefix depend on that prefix alone, so each prefix
has one last token. The table stores it: an automaton reports all pieces that end at a position, and
the one that is the last token there is the only piece that (a) is the encoding of its own text and
(b) is compatible with the last token of the prefix before it: encoding the two texts together
gives the two pieces back. Ids are read off backwards from the end of the table.

Pieces hold the space mark only at their start, so a text splits into marks-then-letters units that
never merge across their borders; a bounded cache keeps the results of short units. Runs of two or
more marks are merged step by step instead, since their pieces tie in score and the table needs a
strict order.

Defined results: a null text is an empty one and has the end id only; characters outside the
vocabulary become byte pieces; the mark character itself decodes to a space, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, worker_cache

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Units up to this length are kept in the cache, this many in each of its two generations.
CACHED_CHARS, CACHED_UNITS = 48, 200_000
KNOWN_PAIRS = 300_000


class PieceTable:
    """A BPE model's pieces, encoder and decoder."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end, self.unknown = model.eos_id(), model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = {i for i in range(len(self.pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = special
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special and i not in self.byte_of}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with a space mark inside are not supported")
        self.shown = [p.replace(MARK, " ") for p in self.pieces]
        self.plain = frozenset(self.ids.values())
        self.number = [f" {i}" for i in range(len(self.pieces))]
        # each piece with its length and what is known of the pieces before it
        self.known: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1 and self.merged(p) == [p]:
                self.known[p] = {}
                self.automaton.add_word(p, (len(p), p, self.known[p]))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.new: dict[str, tuple[str, int, str]] = {}
        self.old: dict[str, tuple[str, int, str]] = {}

    def merged(self, text: str) -> list[str]:
        """Step-by-step merging: the best-scored adjacent pair first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        score = self.score
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (both := parts[a] + parts[b]) in score:
                heapq.heappush(heap, (-score[both], a, b, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or right[a] != b or parts[a] + parts[b] != both:
                continue
            parts[a], parts[b] = both, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p is not None]

    def fits(self, a: str, b: str) -> bool:
        """Whether a and b stay apart side by side; remembered for up to KNOWN_PAIRS pairs."""
        if self.pairs >= KNOWN_PAIRS:
            for known in self.known.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        fit = self.known[b][a] = self.merged(a + b) == [a, b]
        return fit

    def prefix_table(self, unit: str) -> list[str]:
        """The unit's pieces, from the last token of each of its prefixes."""
        last = ["", *unit]
        if len(self.automaton):
            found = 0
            for end, (size, piece, known) in self.automaton.iter(unit):  # by end; of one end at most one piece is right
                if end >= found:
                    start = end + 1 - size
                    if start:
                        before = last[start]
                        fit = known.get(before)
                        if not (self.fits(before, piece) if fit is None else fit):
                            continue
                    last[end + 1] = piece
                    found = end + 1
        out, i = [], len(unit)
        while i:
            out.append(last[i])
            i -= len(last[i])
        return out[::-1]

    def unit_ids(self, unit: str) -> list[int]:
        ids: list[int] = []
        for piece in self.merged(unit) if unit[:2] == MARK * 2 else self.prefix_table(unit):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self.bytes:
                ids += [self.bytes[b] for b in piece.encode("utf-8")]
            else:
                ids.append(self.unknown)
        return ids

    def _decoded(self, ids: list[int]) -> str:
        """Text with marks as spaces; bytes that are not valid UTF-8 become U+FFFD each."""
        out, held = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i >= 0 and i not in self.control:
                out.append(self.pieces[i].replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids): the first piece's leading space belongs to no text."""
        shown = [i for i in ids if i not in self.control or i == self.unknown]
        text = self._decoded(shown)
        return text[1:] if shown and shown[0] in self._marked else text

    @property
    def _marked(self) -> set[int]:
        if not hasattr(self, "_marked_ids"):
            self._marked_ids = {i for p, i in self.ids.items() if p.startswith(MARK)}
        return self._marked_ids

    def _unit(self, unit: str) -> tuple[str, int, str]:
        """(ids as text with a space before each, their number, decoded text) of a unit, by way of the cache."""
        got = self.old.get(unit)
        if got is None:
            ids = self.unit_ids(unit)
            shown, number = self.shown, self.number
            text = "".join([shown[i] for i in ids]) if self.plain.issuperset(ids) else self._decoded(ids)
            got = ("".join([number[i] for i in ids]), len(ids), text)
        if len(unit) <= CACHED_CHARS:
            if len(self.new) >= CACHED_UNITS:
                self.old, self.new = self.new, {}
            self.new[unit] = got
        return got

    def encode(self, text: str) -> list[int]:
        """The text's ids with the end id."""
        return [*(i for u in self.units(text) for i in self.unit_ids(u)), self.end]

    @staticmethod
    def units(text: str) -> list[str]:
        return UNIT.findall(MARK + text.replace(" ", MARK)) if text else []

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids as text, sha256 of the decoded text), without lists of all ids."""
        units = self.units(text)
        got = list(map(self.new.get, units))
        for k, x in enumerate(got):
            if x is None:
                got[k] = self._unit(units[k])
        ids = "".join([x[0] for x in got]) + self.number[self.end]
        # the first unit starts with the mark that the library puts before every text
        text = "".join([x[2] for x in got])[1:]
        return sum([x[1] for x in got]) + 1, hashlib.sha256(ids[1:].encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def _utf8(raw: bytes) -> str:
    """Valid sequences decode; each other byte becomes one U+FFFD."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            i += min(n, len(raw) - i)
            break
        else:
            out.append("�")
            i += 1
    return "".join(out)


def piece_table(path: str) -> PieceTable:
    """One table in each Python worker."""
    _tables = worker_cache("pieces")
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = piece_table(path)
        for texts in batches:
            yield pd.DataFrame([model.digest(t or "") for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(docs).select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("x")).select("doc_id", "x.*")
