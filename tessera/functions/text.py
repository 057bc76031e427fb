"""Text functions as columns: identifiers, token estimates, normalisation, fingerprints.

Only Unicode normalisation, case folding and the C library's exp need Python, and only rows that these may change are handed to it.
White space is Unicode's; anchors are \\A and \\z, since $ also matches before a line end.
"""

from __future__ import annotations

import math
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: Separates the parts of hashed keys.
PART = "\x1f"
#: What ends a line in raw text, and in text without control characters.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
OTHER_ENDS = "[\x85\u2028\u2029]"
CONTROLS = "[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: White space within a line of text without control characters, and all white space.
BLANK = "[ \t\xa0\u1680\u2000-\u200a\u202f\u205f\u3000]"
SPACE = "[ \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Lines that carry no content. Lines have no blanks at their ends here.
LEADER_LINE = rf"(?md)^{BLANK}*+(?!{BLANK}).{{2,100}}\.{{5,}}{BLANK}*\p{{Nd}}++(?:\n|\z)"
BOILERPLATE_LINE = rf"(?mdiu)^{BLANK}*+(?:table of contents|skip to (?:main )?content|previous|next|edit on github|©{BLANK}*+copyright(?![\p{{L}}\p{{N}}_])[^\n]*+)(?:\n|\z)"
#: Characters that NFC leaves alone, whatever stands beside them; and those that NFKC leaves alone and lower() folds, but for \xdf.
COMPOSED = "\\x00-\u02ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3\ufffd"
FOLDED = "\\x00-\\x7f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff\u2013\u2014\u2018-\u201e\u2020-\u2022\u20ac"


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+\z", "")


def strip(c: Column) -> Column:
    return rstrip(lstrip(c))


def truthy(c: Column) -> Column:
    """The value, or null for an empty string, so that coalesce() reads like a chain of fallbacks."""
    return F.nullif(c, F.lit(""))


def joined(*parts: Column) -> Column:
    """Parts with the separator between them; concat_ws would skip nulls."""
    out = [x for p in parts for x in (F.lit(PART), F.coalesce(p.cast("string"), F.lit("None")))]
    return F.concat(*out[1:])


def stable_id(*parts: Column, length: int = 24) -> Column:
    return F.substring(F.sha2(joined(*parts), 256), 1, length)


def document_sort_key(source: Column, document: Column, seed: int = 42) -> Column:
    """Hexadecimal digits sort as the digest's bytes do."""
    return F.sha2(joined(F.lit(seed), source, document), 256)


def seeded_hash(value: Column, seed: int = 42) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), value.cast("string")), 256)


def estimate_tokens(text: Column) -> Column:
    """A quarter of the length, rounded half to even, at least 1."""
    return F.greatest(F.lit(1), F.bround(F.length(text) / F.lit(4.0))).cast("long")


def floor_tokens(text: Column) -> Column:
    """The trainer's estimate: a quarter of the length, rounded down."""
    return F.floor(F.length(text) / F.lit(4.0)).cast("long")


def perplexity(loss: Column) -> Column:
    """Infinite from a loss of 100 on and where it is not a number; no loss has none."""
    return F.when(loss < 100, F.exp(loss)).when(loss.isNotNull(), F.lit(float("inf")))


@F.pandas_udf(DoubleType())
def _library_exp(x: pd.Series) -> pd.Series:
    return x.map(math.exp, na_action="ignore")


def rounded_perplexity(loss: Column, digits: int) -> Column:
    """Perplexity to some decimals, halves up, with the C library's exp.

    The JVM's exp may differ from it in the last bit, which decides next to a half, and always where a bit is half a unit of the last
    decimal or more. Only such rows reach Python; others reach it as nulls.
    """
    scale, p = F.lit(10.0**digits), perplexity(loss)
    off = F.abs(p * scale - F.rint(p * scale))
    near = F.abs(off - 0.5) <= p * scale * 1e-15
    scaled = F.coalesce(_library_exp(F.when((loss < 100) & near, loss)), p) * scale
    return (F.rint(scaled) + F.when(scaled - F.rint(scaled) == 0.5, 1.0).otherwise(0.0)) / scale


def steps_per_epoch(tokens: Column, max_length: int, per_device: int, world: int, accumulation: int) -> Column:
    return F.ceil(tokens / F.lit(float(max_length * per_device * world * accumulation))).cast("long")


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def _where_needed(udf, text: Column, safe: str, common: str, plain: Column) -> Column:
    """The Python function's result for rows with other than safe characters; others reach Python as nulls.

    A class of one or two ranges, common, is much faster to test, and few texts go beyond it.
    """
    return F.coalesce(udf(F.when(text.rlike(f"[^{common}]") & text.rlike(f"[^{safe}]"), text)), plain)


def normalize_text(text: Column) -> Column:
    """Line ends, NFC, control characters, empty furniture lines, trailing space and long gaps; indentation stays.

    Patterns run over the whole text: a line that goes takes its line end with it.
    """
    ends = F.regexp_replace(text, "\r\n?", "\n")
    composed = _where_needed(_nfc, ends, COMPOSED, "\\x00-\u02ff", ends)
    lines = F.regexp_replace(F.regexp_replace(composed, CONTROLS, ""), OTHER_ENDS, "\n")
    even = F.regexp_replace(lines, rf"{BLANK}++(?=\n|\z)", "")
    kept = F.regexp_replace(F.when(F.contains(even, F.lit(".....")), F.regexp_replace(even, LEADER_LINE, "")).otherwise(even), BOILERPLATE_LINE, "")
    # blanks are left at the beginning only
    short = F.regexp_replace(F.regexp_replace(kept, "\n{4,}", "\n\n\n"), rf"\A{SPACE}+", "")
    return F.rtrim(short, F.lit("\n"))


def fold_text(text: Column) -> Column:
    """Compatibility form, case folded, white space as single spaces."""
    plain = F.replace(F.lower(text), F.lit("\xdf"), F.lit("ss"))
    return F.trim(F.regexp_replace(_where_needed(_folded, text, FOLDED, "\\x00-\\x7f\xbf-\xff", plain), rf"{SPACE}+", " "))


def exact_fingerprint(text: Column) -> Column:
    return F.sha2(fold_text(text), 256)


def raw_lines(text: Column) -> Column:
    """Lines as a text editor counts them: a last line end does not start another line."""
    lines = F.split(text, LINE_ENDS, -1)
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
