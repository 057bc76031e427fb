"""Splitting texts into titled sections, row by row without a shuffle: lines are an array, borders its indices.

Intermediate arrays are bound inside the expression (let), since a column that a lambda refers to would be computed anew for
every element once projections are merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import raw_lines, strip

HEADING = r"(?U)\A(#{1,6})\s+(.+?)\s*\z"
UNDERLINE = "(?U)\\A([=\\-~^\"'`:+*#<>_])\\1{2,}\\s*\\z"
FENCE = r"\A\s*(```|~~~)"
Value = Callable[[Column], Column]


def let(value: Column, body: Value) -> Column:
    """body(value), with value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _title(line: Column, fallback: Column) -> Column:
    text = F.regexp_replace(F.regexp_extract(line, HEADING, 2), r"\A[ #]+|[ #]+\z", "")
    return F.when(line.rlike(HEADING) & (text != ""), text).otherwise(fallback)


def _bodies(lines: Column, borders: Column) -> Column:
    """Non-empty sections between borders: an ascending array of structs at (line number), title."""

    def one(b: Column, k: Column) -> Column:
        end = F.coalesce(F.get(borders, k + 1)["at"], F.size(lines))
        return F.struct(b["title"].alias("title"), strip(F.array_join(F.slice(lines, b["at"] + 1, end - b["at"]), "\n")).alias("body"), k.alias("border"))

    return F.filter(F.transform(borders, one), lambda s: s["body"] != "")


def _explode(df: DataFrame, sections: Column) -> DataFrame:
    """One row for each section, numbered from 0; border_no also counts those left out."""
    own = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*own, F.posexplode(sections).alias("section_no", "_s")).select(*own, "section_no", F.col("_s.title").alias("section_title"), "_s.body", F.col("_s.border").alias("border_no"))


def _some(df: DataFrame, text_col: str) -> DataFrame:
    return df.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))


def _numbered(lines: Column, border: Callable[[Column, Column], Column], title: Callable[[Column, Column], Column]) -> Column:
    """Borders where border(line, number) holds."""
    marked = F.transform(lines, lambda x, i: F.when(border(x, i), F.struct(i.alias("at"), title(x, i).alias("title"))))
    return F.filter(marked, lambda b: b.isNotNull())


def _fences(lines: Column) -> Column:
    """For each line whether it stands in an open code fence."""
    state = F.struct(F.lit(False).alias("open"), F.array().cast("array<boolean>").alias("out"))
    step = lambda s, x: F.struct(F.when(x.rlike(FENCE), ~s["open"]).otherwise(s["open"]).alias("open"), F.array_append(s["out"], s["open"]).alias("out"))
    return F.aggregate(lines, state, step, lambda s: s["out"])


def markdown_sections(df: DataFrame, text_col: str, fallback: Column, fence_aware: bool = False) -> DataFrame:
    """A section for every heading of any level; text before the first has the fallback title.

    Lines in code fences that look like headings start sections too, unless fence_aware.
    """

    def cut(lines: Column) -> Column:
        def borders(fenced: Column | None) -> Column:
            shown = lambda x, i: x.rlike(HEADING) & (~F.get(fenced, i) if fenced is not None else F.lit(True))
            return _numbered(lines, lambda x, i: (i == 0) | shown(x, i), lambda x, i: F.when(shown(x, i), _title(x, fallback)).otherwise(fallback))

        found = let(_fences(lines), lambda f: let(borders(f), lambda b: _bodies(lines, b))) if fence_aware else let(borders(None), lambda b: _bodies(lines, b))
        return found

    return _explode(_some(df, text_col), let(raw_lines(F.col(text_col)), cut))


def markdown_chapters(df: DataFrame, text_col: str, fallback: Column) -> DataFrame:
    """Chapters at one heading level: the shallowest, unless it occurs once and a deeper one repeats. What stands
    before the first chapter belongs to it; a text without headings is one chapter."""
    level_of = lambda x: F.length(F.regexp_extract(x, HEADING, 1))

    def level(levels: Column) -> Column:
        """The chapter level among all headings' levels."""
        times = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda n: F.size(F.filter(levels, lambda x: x == n)))
        return let(times, lambda t: let(F.array_min(levels), lambda top: F.when(F.element_at(t, top) == 1, F.coalesce(F.get(F.filter(F.sequence(F.lit(1), F.lit(6)), lambda n: (n > top) & (F.element_at(t, n) >= 2)), F.lit(0)), top)).otherwise(top)))

    def cut(lines: Column) -> Column:
        heads = F.transform(F.filter(lines, lambda x: x.rlike(HEADING)), level_of)

        def at(chosen: Column) -> Column:
            found = _numbered(lines, lambda x, i: x.rlike(HEADING) & (level_of(x) == chosen), lambda x, i: _title(x, fallback))
            first = lambda b, k: F.struct(F.when(k == 0, F.lit(0)).otherwise(b["at"]).alias("at"), b["title"].alias("title"))
            whole = F.array(F.struct(F.lit(0).alias("at"), fallback.alias("title")))
            return let(found, lambda f: let(F.when(F.size(f) == 0, whole).otherwise(F.transform(f, first)), lambda b: _bodies(lines, b)))

        return let(heads, lambda h: let(F.when(F.size(h) > 0, level(h)).otherwise(F.lit(0)), at))

    return _explode(_some(df, text_col), let(raw_lines(F.col(text_col)), cut))


def rst_sections(df: DataFrame, text_col: str, fallback: Column) -> DataFrame:
    """A section for every underlined title; overlines stay with the section before."""

    def cut(lines: Column) -> Column:
        titled = lambda x, i: F.coalesce(F.get(lines, i + 1).rlike(UNDERLINE), F.lit(False)) & (strip(x) != "")
        borders = _numbered(lines, lambda x, i: (i == 0) | titled(x, i), lambda x, i: F.when(titled(x, i), strip(x)).otherwise(fallback))
        return let(borders, lambda b: _bodies(lines, b))

    return _explode(_some(df, text_col), let(raw_lines(F.col(text_col)), cut))
