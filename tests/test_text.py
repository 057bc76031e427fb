import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.quality import QualityRules, rejection_reason
from tessera.functions.values import arguments_json, as_set, json_type, metadata_object, parse_arguments, string_set


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_token_estimates(spark):
    assert column(spark, ["", "a", "ab", "abcdef", "a" * 10], T.estimate_tokens) == [1, 1, 1, 2, 2]
    assert column(spark, ["", "abc", "abcd", "a" * 11], T.floor_tokens) == [0, 0, 1, 2]


def test_ids_and_hashes(spark):
    assert column(spark, ["x", None], lambda c: T.stable_id(c, F.lit(3))) == [hashlib.sha256(f"{v}\x1f3".encode()).hexdigest()[:24] for v in ("x", None)]
    assert column(spark, ["v"], T.seeded_hash) == [hashlib.sha256(b"42:v").hexdigest()]


#: Texts and their normal forms, written by hand from the rules.
NORMAL = [
    ("TABLE OF CONTENTS\n\ninterface eth0\n    mtu 9000\n\n\n\n\nprevious", "interface eth0\n    mtu 9000"),
    ("one\r\ntwo\rthr\x00ee\x0bfour", "one\ntwo\nthreefour"),
    ("Setup ........ 7\nText.  \n\n\n\n\n\nLast\x85x\u2028y", "Text.\n\n\nLast\nx\ny"),
    ("Ab..... 3\nA..... 3\nAbc.... 3\nab.....\u20093\u2003", "A..... 3\nAbc.... 3"),
    ("\xa9 Copyright 2020 by all\n\xa9copyright\n\xa9\t  COPYRIGHT x\n\xa9 copyrighted\nskip to content\nSkip To Main Content \nedit on github\nPrevious page", "\xa9 copyrighted\nPrevious page"),
    ("e\u0301   lead\n  indented\xa0\n\u3000", "\xe9   lead\n  indented"),
    ("next\nNext\nx\nnext", "x"),
    ("\u212b and \u1100\u1161 and \u2126", "\xc5 and \uac00 and \u03a9"),
    ("   \n\n  ", ""),
    ("", ""),
]


def test_normalisation(spark):
    assert column(spark, [t for t, _ in NORMAL], T.normalize_text) == [n for _, n in NORMAL]


def test_safe_characters_need_no_python():
    for ranges, form in ((T.COMPOSED, "NFC"), (T.FOLDED, "NFKC")):
        for c in map(chr, range(0x10000)):
            if not 0xD800 <= ord(c) < 0xE000 and not re.match(f"[^{ranges}]", c):
                assert unicodedata.normalize(form, c) == c and unicodedata.combining(c) == 0
                assert form == "NFC" or c.casefold() == c.lower().replace("\xdf", "ss")
                # nothing in these ranges joins with a neighbour
                assert unicodedata.normalize(form, "A" + c) == "A" + c


def test_fingerprints(spark):
    texts = ["BGP  Route\n", "bgp route", "Straße ﬁ", "STRASSE fi", "é", "é"]
    got = column(spark, texts, T.exact_fingerprint)
    assert got == [hashlib.sha256(" ".join(unicodedata.normalize("NFKC", t).casefold().split()).encode()).hexdigest() for t in texts]
    assert got[0] == got[1] and got[2] == got[3] and got[4] == got[5]


GOOD = "Plain words that are long enough to pass. " * 6


@pytest.mark.parametrize(
    "text,license_,reason",
    [
        ("x" * 199, "MIT", "too_short"),
        (GOOD, " ", "missing_license"),
        (GOOD, None, "missing_license"),
        ("https://a.example/" + "b" * 200 + "\n HTTP://c.example ", "MIT", "url_only"),
        (GOOD + "https://a.example", "MIT", None),
        (GOOD + "=" * 15, "MIT", None),
        (GOOD + "=" * 16, "MIT", "repeated_punctuation"),
        (GOOD + "é" * 16 + "_" * 20, "MIT", None),
        ("a" * 198 + "�" * 2, "MIT", None),
        ("a" * 197 + "�" * 3, "MIT", "too_many_replacement_chars"),
        ("a" * 40 + "+-" * 80, "MIT", None),
        ("a" * 39 + "+-" * 80 + "!", "MIT", "low_alnum_ratio"),
        (GOOD, "MIT", None),
    ],
)
def test_quality(spark, text, license_, reason):
    df = spark.createDataFrame([(text, license_)], "t string, l string")
    assert df.select(rejection_reason(F.col("t"), F.col("l"))).first()[0] == reason


def test_exempt_underlines(spark):
    text = "A heading of the manual\n" + "=" * 23 + "\n" + GOOD
    df = spark.createDataFrame([(text, "MIT")], "t string, l string")
    rules = [QualityRules(), QualityRules(exempt_underlines=True)]
    assert [df.select(rejection_reason(F.col("t"), F.col("l"), r)).first()[0] for r in rules] == ["repeated_punctuation", None]


def test_values(spark):
    assert column(spark, ["true", "1", "1.5", "[1]", '{"a": 1}', '"x"', "null", "nope"], json_type) == ["boolean", "number", "number", "array", "object", "string", "string", "string"]
    assert column(spark, ['{"b": {"c": 1}}', "[1,2]", "no json", None], metadata_object) == ['{"b":{"c":1}}', '{"value":[1,2]}', '{"raw":"no json"}', "{}"]
    assert column(spark, ['{"a": 1}', "{'a': True}", "[1]", "import os", None], arguments_json) == ['{"a": 1}', '{"a": true}', None, None, None]
    assert string_set(["a", 1, 1]) == {"a", "1"} and string_set("x") == {"x"} and string_set(None) == string_set("") == frozenset()
    assert column(spark, [["b", "a", "b"], None], as_set, "array<string>") == [["a", "b"], []]
    with pytest.raises(ValueError):
        parse_arguments("{'a': }")
