import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.packing import CAPACITY, cut, encoder, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, rows):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= CAPACITY
    assert sorted(by_seq) == list(range(len(by_seq)))
    wanted = defaultdict(list)
    for i, t in docs:
        ids = np.array([*encoder(PATH).full.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[i].append(ids)
    assert set(wanted) == set(by_doc)
    for i, copies in wanted.items():
        expected = []
        for ids in copies:
            at = 0
            for n, _ in cut(len(ids)):
                expected.append((at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
                at += n
            assert at == len(ids)
        assert sorted(expected) == sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_doc[i])
    return by_seq


def test_every_id_once_and_little_padding(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    seqs = check(docs, pack(odd_docs, PATH).collect())
    used = sum(p["length"] for s in seqs.values() for p in s)
    assert len(seqs) * CAPACITY - used < CAPACITY + 0.03 * used
    assert pack(no_docs, PATH).count() == 0


def test_classes_hold_a_fixed_number(spark):
    docs = [(i, " a" * (200 + 37 * (i % 50))) for i in range(600)]
    seqs = check(docs, pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect())
    used = sum(p["length"] for s in seqs.values() for p in s)
    assert (len(seqs) * CAPACITY - used) / used < 0.02


@given(st.integers(1, 20_000))
def test_cuts_cover_and_fit_their_class(n):
    pieces = cut(n)
    assert sum(p for p, _ in pieces) == n
    assert all(p * k <= CAPACITY and CAPACITY - p * k <= CAPACITY // 16 for p, k in pieces if p >= 64)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from(" 's'll\n\t<|endoftext|>漢é")), max_size=60))
def test_ids_equal_the_library(text):
    e = encoder(PATH)
    assert e.fast is not None
    assert list(e.ids(text)) == e.full.encode(text, add_special_tokens=False).ids
