import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, size long, shard string, `cells` string, name string, block int"


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long_text = " ".join(f"word{i % 977} other{i % 31}." for i in range(20_000))
    texts = ["", None, "   ", "one", "two words", "Same text here, all of it.\nSecond line.", "Same text here, all of it.\nSecond line.", long_text, "éà ß 漢字 😀 <|endoftext|> x", "123 456 --", "a\x00b\tc\r\nd", "tie", "tie"]
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or ""), 1, 2, "x", "y", "z", 3) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id at all here", None, None, None, None, None, None, None, None, None), (None, None, *[None] * 9)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
