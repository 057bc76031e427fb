import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.pieces import encode_digests, piece_table

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def wanted(text):
    ids = LIBRARY.encode(text, add_eos=True)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


ALPHABET = st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list("theing anrtsol  ▁▁\n") + ["the", "tion", "ing ", "    ", "<s>", "</s>", "<0x0A>"]))


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_equals_the_library(text):
    table = piece_table(PATH)
    assert table.digest(text) == wanted(text)
    ids = LIBRARY.encode(text, add_eos=True)
    assert table.encode(text) == ids and table.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_decodes_any_ids(ids):
    ids = [i for i in ids if i]  # the unknown id has a surface of its own
    assert piece_table(PATH).decode(ids) == LIBRARY.decode(ids)


def test_small_cache_changes_nothing(monkeypatch):
    from tessera.llm import pieces

    monkeypatch.setattr(pieces, "CACHED_UNITS", 3)
    monkeypatch.setattr(pieces, "KNOWN_PAIRS", 5)
    text = " ".join(f"the{i % 9}ing tion{i % 7}" for i in range(300))
    assert pieces.PieceTable(PATH).digest(text) == wanted(text)


def test_rows(spark, odd_docs, no_docs):
    got = encode_digests(odd_docs, PATH).collect()
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(wanted(r["text"] or "") for r in odd_docs.collect())
    assert encode_digests(no_docs, PATH).count() == 0
