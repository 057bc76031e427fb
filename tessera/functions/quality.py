"""Ordered quality rules: the first that fails names the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import lstrip, strip


@dataclass(frozen=True)
class QualityRules:
    min_chars: int = 200
    min_alnum_ratio: float = 0.20
    max_replacement_ratio: float = 0.01
    #: Sixteen equal symbols in a row reject a text. That also hits long heading underlines; exempting lines
    #: that consist of them is a choice.
    exempt_underlines: bool = False


REASONS = ("too_short", "missing_license", "url_only", "repeated_punctuation", "too_many_replacement_chars", "low_alnum_ratio")
REPEATED = r"(?U)([^\p{L}\p{N}_\s])\1{15,}"


def rejection_reason(text: Column, license_: Column, rules: QualityRules | None = None) -> Column:
    """The first failing rule's name, or null. Cheap rules come first, and later ones are not evaluated then."""
    rules = rules or QualityRules()
    size = F.greatest(F.lit(1), F.length(text)).cast("double")
    tokens = F.split(strip(text), r"(?U)\s+")
    shown = F.regexp_replace(text, r"(?m)^[ \t]*([=\-~^\"'`:+*#<>_])\1{2,}[ \t]*$", "") if rules.exempt_underlines else text
    replaced = F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))
    alnum = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))
    url = r"(?i)\Ahttps?://."
    return (
        F.when(F.length(text) < rules.min_chars, "too_short")
        .when(strip(F.coalesce(license_, F.lit(""))) == "", "missing_license")
        .when(lstrip(text).rlike(url) & F.forall(tokens, lambda t: t.rlike(url)), "url_only")
        .when(shown.rlike(REPEATED), "repeated_punctuation")
        .when(replaced / size > rules.max_replacement_ratio, "too_many_replacement_chars")
        .when(alnum / size < rules.min_alnum_ratio, "low_alnum_ratio")
    )
