"""Main text of web pages by tag-path ratios.

A page's text blocks are grouped by their root-to-leaf tag path. Each path has the mean text length
and the mean punctuation of its blocks; both series are smoothed over the blocks in page order and
fused; the paths over a threshold from the spread of the fused values are content. The element that
holds most of the content is the container: its other blocks (titles, short paragraphs, list items) come along
unless they are furniture, or stand in lists or boxes that are mostly links.

Marks are part of a path and weigh its value: an element that is furniture by its tag, role or class divides it by a thousand,
an article or main element doubles it. So a page's own marks help, but marked teaser cards do not beat the text. Class
words count by the last part of a name that says anything (site-footer, not share-holders). Words that articles
use too (related, share, alert) and forms count only where the element's own text reads like furniture: short, without
sentences, or mostly links. A box that begins with a heading like "3 comments" is one of reader comments.

Defined results: null and empty pages, and pages without text or with nothing but furniture, give an empty string; an unfinished tag
or comment at the end is dropped; unclosed elements end where HTML's block structure ends them;
repeated rows give repeated results; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？·()\"“”«»]")
_END = re.compile(r"[.!?…。！？][\"”»)]?(?:\s|$)")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# HTML elements, and words that name page furniture.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr label".split())
FURNITURE = frozenset("nav footer aside".split())
UNSEEN = frozenset("button select option menu dialog head fieldset datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus reply replies respond toolbar pagination pager copyright".split()
)
#: Words that articles use too.
WEAK = frozenset("banner promo promotion share sharing social related recommended widget skip rail trending alert form search feedback discussion teaser teasers".split())
#: Parts of a class name that say nothing of themselves.
NEUTRAL = frozenset(
    "site page main top bottom left right primary secondary global local box bar block container wrapper wrap area list item items link links button buttons icon icons "
    "panel section inner outer content body text title heading group row col column module region post posts entry article articles story stories blog count message "
    "info zone slot unit small large mobile desktop sticky fixed js id".split()
)
MARKS = frozenset(("article", "main"))
REMARKS = frozenset("comment comments disqus reply replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold words rather than boxes.
WORDED = HEADINGS | frozenset("p li dt dd td th blockquote pre figure figcaption caption".split())
REMARK_HEADING = re.compile(r"(?:\d+ |reader |leave an? |user |post an? )?(?:comments?|responses|replies|kommentare?|leserkommentare|commentaires?|comentarios?)(?: ?\(?\d+\)?)?:?", re.I)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body html article main section div nav aside footer header form select".split())
#: What a furniture element and an article element do to a path's value.
OFF, ON = 0.001, 2.0


@dataclass
class Block:
    text: str
    links: int
    #: The elements around it, outermost first: (label, number, whether its text decides if it is furniture).
    around: tuple[tuple[str, int, bool], ...]
    path: str = ""
    weight: float = 1.0

    @property
    def tag(self) -> str:
        return self.around[-1][0].rstrip("!") if self.around else ""


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(raw)}


def _named(own: dict[str, str]) -> set[str]:
    """The words that classes and id end with, apart from neutral parts."""
    out = set()
    for token in f"{own.get('class', '')} {own.get('id', '')}".split():
        parts = [x.lower() for x in _PART.findall(token)]
        last = next((x for x in reversed(parts) if len(x) > 1 and x not in NEUTRAL), "")
        # a doubtful word with a sure one, as in cookie-banner, is sure
        out.add(next((x for x in parts if x in WORDS), last) if last in WEAK else last)
    return out


def _kind(tag: str, raw: str, inside: bool) -> str:
    """What an element is: unseen, furniture, doubtful (its text decides), or nothing. A header within an article belongs to it."""
    if tag in UNSEEN:
        return "unseen"
    if tag in FURNITURE or tag == "header" and not inside:
        return "furniture"
    own = _attributes(raw) if raw and not raw.isspace() else {}
    if "hidden" in own or own.get("aria-hidden") == "true" or _HIDDEN.search(own.get("style", "")):
        return "unseen"
    if own.get("role", "").lower() in ROLES or own.get("itemprop") == "comment" or own.get("itemtype", "").endswith("Comment"):
        return "furniture"
    words = _named(own)
    if tag in ("html", "body", "main"):
        return ""
    if tag == "article":
        return "furniture" if words & REMARKS else ""
    if words & WORDS - ({"header"} if inside else set()):
        return "furniture"
    return "doubtful" if tag == "form" or words & WEAK and tag not in WORDED else ""


def _after(html: str, tag: str, at: int) -> int:
    """The place after an element's end, of elements of its name within it; at if it has none."""
    depth, where = 1, at
    for m in re.compile(f"<(/?){tag}(?=[\\s/>])[^>]*>", re.I).finditer(html, at):
        depth += -1 if m[1] else 1
        where = m.end()
        if not depth:
            return where
    return at


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, but for unseen ones."""
    stack: list[tuple[str, int, bool, bool, bool, str]] = [("", 0, False, False, False, "")]  # tag, number, unseen, doubtful, inside, label
    out: list[Block] = []
    parts: list[str] = []
    state = {"links": 0, "n": 0}
    in_link = False

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and not stack[-1][2]:
                out.append(Block(text, state["links"], tuple((s[5], s[1], s[3]) for s in stack[1:])))
            parts.clear()
        state["links"] = 0

    def text_to(end: int, start: int) -> None:
        if end > start:
            piece = html[start:end]
            parts.append(piece)
            if in_link:
                state["links"] += len(" ".join(piece.split()))

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if not m:
            text_to(n, at)
            break
        text_to(m.start(), at)
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, raw = tag.lower(), (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append(" ")
        elif tag in RAW and not closing:
            if not raw.rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else n
        elif tag in INLINE or tag in RAW:
            if not closing and tag in ("span", "label") and raw and _kind(tag, raw, True) in ("unseen", "furniture"):
                at = _after(html, tag, at)  # furniture among words
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif closing:
            if any(s[0] == tag for s in stack):
                flush()
                in_link = False
                while stack.pop()[0] != tag:
                    pass
            elif tag == "p":
                flush()
        else:
            flush()
            in_link = False
            shut = CLOSES.get(tag, ())
            if any(s[0] == "p" for s in stack):  # a block ends an open paragraph
                k = max(i for i, s in enumerate(stack) if s[0] == "p")
                if not any(s[0] in SCOPES for s in stack[k + 1 :]):
                    del stack[k:]
            if shut:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in shut:
                        del stack[k:]
                        if tag != "tr":
                            break
                    elif stack[k][0] in SCOPES:
                        break
            unseen, inside = stack[-1][2], stack[-1][4]
            state["n"] += 1
            kind = _kind(tag, raw, inside)
            if not raw.rstrip().endswith("/"):
                stack.append((tag, state["n"], unseen or kind == "unseen", kind == "doubtful", inside or tag in MARKS, tag + ("!" if kind == "furniture" else "")))
    flush()
    return out


def _settle(found: list[Block]) -> None:
    """Paths and weights, once it is known which doubtful elements and which boxes of remarks are furniture."""
    whole = sum(len(b.text) for b in found)
    size, links, sentences, count, first = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int), {}
    for b in found:
        for label, k, _ in b.around:
            size[k] += len(b.text)
            links[k] += min(b.links, len(b.text))
            sentences[k] += len(b.text) >= 40 and bool(_END.search(b.text))
            count[k] += 1
            first.setdefault(k, b)
    # a box of some links, buttons or single words; a form may wrap the page
    poor = lambda k, tag: 2 * links[k] >= size[k] or 2 * sentences[k] < count[k] if tag != "form" else size[k] <= 0.6 * whole
    for b in found:
        labels = []
        for label, k, doubtful in b.around:
            opens = first[k]
            remarks = label not in WORDED and label not in MARKS and opens.tag in HEADINGS and 2 * size[k] < whole and REMARK_HEADING.fullmatch(opens.text)
            labels.append(label + "!" if doubtful and poor(k, label) or remarks else label)
        b.path = "/".join(labels)
        b.weight = OFF if any(x.endswith("!") for x in labels) else ON ** min(2, sum(x in MARKS for x in labels))


def _smooth(values: list[float]) -> list[float]:
    """A three-point weighted mean in page order."""
    last = len(values) - 1
    return [(values[max(0, i - 1)] + 2 * v + values[min(last, i + 1)]) / 4 for i, v in enumerate(values)]


def _content(nodes: list[Block]) -> set[str]:
    """The tag paths whose fused ratios exceed the threshold."""
    size, marks, count, links = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for b in nodes:
        size[b.path] += len(b.text)
        marks[b.path] += len(_MARKS.findall(b.text))
        count[b.path] += 1
        links[b.path] += min(b.links, len(b.text))
    long = _smooth([size[b.path] / count[b.path] for b in nodes])
    marked = _smooth([marks[b.path] / count[b.path] for b in nodes])
    fused: dict[str, list[float]] = defaultdict(list)
    for b, x, y in zip(nodes, long, marked):
        # a path's share of the page's text steadies the ratio of paths with one long block
        fused[b.path].append(b.weight * math.sqrt(x * (1 + y)) * (1 - links[b.path] / size[b.path]) * math.sqrt(size[b.path]))
    score = {p: sum(v) / len(v) for p, v in fused.items()}
    mean = sum(score.values()) / len(score)
    spread = math.sqrt(sum((v - mean) ** 2 for v in score.values()) / len(score))
    top = max(score.values())
    limit = min(max(mean, spread), top)
    return {p for p, v in score.items() if v >= limit}


def extract(html: str) -> str:
    """The article's blocks, joined by line ends."""
    nodes = blocks(html) if html else []
    _settle(nodes)
    if all(b.weight == OFF for b in nodes):
        return ""
    paths = _content(nodes)
    total = sum(len(b.text) for b in nodes if b.path in paths)
    mass, count, size, links = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    label = {k: x for b in nodes for x, k, _ in b.around}
    for b in nodes:
        size[b.path] += len(b.text)
        links[b.path] += min(b.links, len(b.text))
        for _, k, _ in b.around:
            mass[k] += len(b.text) if b.path in paths else 0
            count[k] += 1
    # numbers grow with depth along a path, so the largest that holds most of the content is the deepest; 0 is the page
    holds = [k for k, v in mass.items() if v >= 0.8 * total]
    marked = [k for k in holds if label[k] in MARKS]
    container = max(marked or [k for k in holds if label[k] not in WORDED and count[k] > 1], default=0)
    out = []
    for b in nodes:
        beside = b.weight != OFF and (container == 0 or any(k == container for _, k, _ in b.around))
        linked = b.links >= 0.8 * len(b.text) and links[b.path] >= 0.8 * size[b.path] and b.tag not in HEADINGS and b.tag != "p"
        if b.path in paths or beside and not linked:
            out.append(b.text)
    return "\n".join(out)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every whole page."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([extract(h or "") for h in pages_], dtype=object)

    got = small_batches(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), run(F.col(html_col)).alias("text"))
    return got.withColumn("n_chars", F.length("text").cast("long"))
