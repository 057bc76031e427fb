import pytest

from tessera.llm import html as module
from tessera.llm.html import _settle, blocks, extract, extract_pages

BODY = "This is a long sentence of the article, with commas, and more words to read. " * 3
CASES = [
    ("<html><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><article><h1>A title</h1><p>First &amp; <b>bold</b> text.<p>Second\n  line.</article><footer>&copy; x</footer></body>", "A title\nFirst & bold text.\nSecond line."),
    (f"<body><div class='menu'><a href=x>one</a> <a href=y>two</a></div><div id=content><h2>Title</h2><p>{BODY}</p><p>Short.</p><p>{BODY}</p></div><div class='sidebar'><p>{BODY}</p></div><div id=comments><p>{BODY}</p></div></body>", f"Title\n{BODY.strip()}\nShort.\n{BODY.strip()}"),
    (f"<main><header><h1>T</h1></header><p>{BODY}</p><aside>no</aside><form><input><p>mail us</p></form><div class='cookie-notice'>no</div><p>End.</p></main>", f"T\n{BODY.strip()}\nEnd."),
    ("<script>var t='</p>';<p>no</p></script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<article><p>a&nbsp;b &#233; &lt;tag&gt; 1 < 2</p><p>cut <b>here", "a b é <tag> 1 < 2\ncut here"),
    ("<article><p>open <a href='x>y'>link</a> end</p><p", "open link end"),
    ("<p>plain", "plain"),
    ("no tags at all", "no tags at all"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
    ("<article><p>shown</p><div hidden><p>no</p></div><p style='display:none'>no</p><noscript><p>no</p></noscript></article>", "shown"),
    ("<form><div><p>" + BODY + "</p></div></form>", BODY.strip()),
    ("", ""),
    ("<html><head><title>only</title></head><body></body></html>", ""),
]


@pytest.mark.parametrize("html,wanted", CASES)
def test_cases(html, wanted):
    assert extract(html) == wanted


def test_paths_are_block_paths():
    found = blocks("<body><p><b>x<br><p>y<nav class=x>z</body>")
    _settle(found)
    assert [b.path for b in found] == ["body/p", "body/p", "body/nav!"]


def test_deep_and_hostile_pages():
    assert extract("<div>" * 3000 + "deep") == "deep"
    assert extract("<" * 5000 + "p") != None  # noqa: E711
    assert extract("<a b='" + "x" * 50_000) == ""


def test_rows(spark):
    rows = [(1, "u", CASES[0][0], "t"), (1, "u", CASES[0][0], "t"), (None, None, None, None), (3, None, "", "x"), (4, "v", "<p>" + "word " * 100_000, "y")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 5 and by[1]["text"] == CASES[0][1] and by[1]["n_chars"] == len(CASES[0][1])
    assert by[None]["text"] == by[3]["text"] == "" and by[4]["n_chars"] == 499_999
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "html,wanted",
    [
        # teaser cards are marked, the text is not
        (f"<body><div id=text><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p></div><div>{'<article><h3>Card</h3><span>More here</span></article>' * 3}</div></body>", "\n".join([BODY.strip()] * 3)),
        # the article within main has the content; what else main holds is no part of it
        (f"<main><article><h1>T</h1><p>{BODY}</p><p>{BODY}</p></article><div class=teasers><div>Read on</div><div>And this</div></div></main>", f"T\n{BODY.strip()}\n{BODY.strip()}"),
    ],
)
def test_paths_decide_on_marked_pages(html, wanted):
    assert extract(html) == wanted


@pytest.mark.parametrize(
    "html,wanted",
    [
        ("<article><p><a href=x>A whole sentence that links.</a></p></article>", "A whole sentence that links."),
        (f"<div><p>{BODY}</p><p><a href=x>A whole sentence that links.</a></p><p>{BODY}</p></div>", f"{BODY.strip()}\nA whole sentence that links.\n{BODY.strip()}"),
        (f"<article><p>{BODY}</p><ul><li><a href=x>Teaser</a><li><a href=y>Another</a></ul></article>", BODY.strip()),
    ],
)
def test_linked_paragraphs_stay_and_link_lists_go(html, wanted):
    assert extract(html) == wanted


LONG = BODY.strip()


@pytest.mark.parametrize(
    "html,wanted",
    [
        # class words that say furniture only by the way
        (f"<article><p>{BODY}</p><p class='related'>A related matter, told in words.</p></article>", f"{LONG}\nA related matter, told in words."),
        (f"<article><div class='share-holders'>The share holders met.</div><p>{BODY}</p></article>", f"The share holders met.\n{LONG}"),
        (f"<article><p>{BODY}</p><div class='alert'><p>{BODY}</p></div><div class='share'><span>Tweet</span></div><div class='related-posts'><a href=x>One</a></div></article>", f"{LONG}\n{LONG}"),
        (f"<article><p>{BODY}</p><section class=search-results><p>{BODY}</p></section><div class='td-cookie-banner'>{BODY}</div></article>", f"{LONG}\n{LONG}"),
        # an inline advert with an element of its own name
        ("<article><p>One <span class='ad'>buy <span>now</span> please</span> text here.</p></article>", "One text here."),
        ("<article><p>One <span class='ad'>not closed</p><p>two</p></article>", "One not closed\ntwo"),
        # reader comments without a class word
        (f"<body><article><h1>T</h1><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p><section><h2>3 Comments</h2><p>Bob: this is a long remark, of a reader, with marks. And more.</p></section></article>", f"T\n{LONG}\n{LONG}\n{LONG}"),
        (f"<body><div><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p></div><div><h3>Kommentare</h3><p>{BODY}</p></div>", f"{LONG}\n{LONG}\n{LONG}"),
        (f"<article><p>{BODY}</p><div itemprop=comment><p>{BODY}</p></div></article>", LONG),
        # an article about comments keeps its title
        (f"<article><h1>Comments</h1><p>{BODY}</p></article>", f"Comments\n{LONG}"),
        # an unmarked box outside the article, and one within a marked main
        (f"<body><article><h1>T</h1><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p></article><div><span>Latest, greatest. Buy it!</span></div>", f"T\n{LONG}\n{LONG}\n{LONG}"),
        ("<body><nav><a href=x>Home</a> and more words.</nav><footer>Imprint. All of it.</footer></body>", ""),
    ],
)
def test_furniture_and_what_looks_like_it(html, wanted):
    assert extract(html) == wanted


def _restated(html):
    """The ratios once more, over a document tree of the standard library's parser, for pages of simple structure."""
    from html.parser import HTMLParser

    rows, stack, seen = [], [], [0]

    class Reader(HTMLParser):
        skip, link = None, False

        def cut(self):
            rows.append([tuple(stack), "", 0])

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style", "title"):
                self.skip = tag
            elif tag == "a":
                self.link = True
            elif tag == "br":
                self.handle_data(" ")
            elif tag not in ("meta", "b"):
                if tag in ("p", "li") and stack and stack[-1][0] == tag:
                    stack.pop()
                seen[0] += 1
                stack.append((tag + "!" * (tag in ("nav", "footer") or dict(attrs).get("class") == "ad"), seen[0]))
                self.cut()

        def handle_endtag(self, tag):
            if tag == self.skip:
                self.skip = None
            elif tag == "a":
                self.link = False
            elif any(t.rstrip("!") == tag for t, _ in stack):
                while stack.pop()[0].rstrip("!") != tag:
                    pass
                self.cut()

        def handle_data(self, data):
            if self.skip is None and rows:
                rows[-1][1] += data
                rows[-1][2] += len(" ".join(data.split())) * self.link

    Reader().feed(html)
    found = [(tuple(t for t, _ in around), {k for _, k in around}, " ".join(text.split()), links) for around, text, links in rows if text.split()]
    by = {}
    for p, _, t, links in found:
        by.setdefault(p, []).append((t, links))
    of = by.get
    length = {p: sum(len(t) for t, _ in of(p)) for p in by}
    mean = [length[p] / len(of(p)) for p, *_ in found]
    marked = {p: sum(c in ".,;:!?…。，、；：！？·()\"“”«»" for t, _ in of(p) for c in t) / len(of(p)) for p in by}
    marks = [marked[p] for p, *_ in found]
    smooth = lambda v: [(v[max(i - 1, 0)] + 2 * v[i] + v[min(i + 1, len(v) - 1)]) / 4 for i in range(len(v))]
    value: dict = {}
    for (p, *_), x, y in zip(found, smooth(mean), smooth(marks)):
        weight = 0.001 if any("!" in t for t in p) else 2.0 ** sum(t in ("article", "main") for t in p)
        value.setdefault(p, []).append(weight * (x * (1 + y)) ** 0.5 * (1 - sum(min(links, len(t)) for t, links in of(p)) / length[p]) * length[p] ** 0.5)
    value = {p: sum(v) / len(v) for p, v in value.items()}
    centre = sum(value.values()) / len(value)
    limit = min(max(centre, (sum((v - centre) ** 2 for v in value.values()) / len(value)) ** 0.5), max(value.values()))
    content = {p for p, v in value.items() if v >= limit}
    total = sum(length[p] for p in content)
    held, blocks_in = dict.fromkeys(range(1, seen[0] + 1), 0), dict.fromkeys(range(1, seen[0] + 1), 0)
    for p, ks, t, _ in found:
        for k in ks:
            held[k] += len(t) * (p in content)
            blocks_in[k] += 1
    full = [k for k, v in held.items() if v >= 0.8 * total]
    tags = {k: t for (p, ks, _, _), around in zip(found, [a for a, text, _ in rows if text.split()]) for t, k in around}
    box = max([k for k in full if tags[k] in ("article", "main")] or [k for k in full if tags[k] not in ("p", "li", "h1") and blocks_in[k] > 1], default=0)
    return "\n".join(t for p, ks, t, _ in found if p in content or not any("!" in x for x in p) and (box == 0 or box in ks))


def test_equals_a_plain_restatement_and_the_ratios_decide(monkeypatch):
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column("html").to_pylist()
    plain = [h.replace("<article>", "<div>").replace("</article>", "</div>") for h in pages]
    whole = pages + plain
    found = [extract(h) for h in whole]
    assert found == [_restated(h) for h in whole]
    for content in (lambda nodes: {b.path for b in nodes}, lambda nodes: {nodes[0].path}):
        monkeypatch.setattr(module, "_content", content)
        assert sum(extract(h) != t for h, t in zip(whole, found)) > 0.9 * len(whole)
