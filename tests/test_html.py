from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from blotterflow.config import MARKER_PATTERN, MARKED_CONTAINER_TAGS
from blotterflow.operators import segment as G
from blotterflow.plans import ingest as I
from blotterflow.sources import html_pages as H
from blotterflow.sources.html_walk import CLOSE, OPEN, TEXT, PageWalk, containers

MARKER = re.compile(MARKER_PATTERN, re.IGNORECASE)


def found(html):
    return containers(PageWalk(html), H.CONTAINER, MARKED_CONTAINER_TAGS, MARKER)


def lines(html, tag="article"):
    walk = PageWalk(html)
    node = next(e for e in walk.elements if e.name == tag)
    layers, spans = walk.lines(H._dropped, H.BLOCKS)
    layer, start, end = spans[node.order]
    return [line.strip() for line in layers[layer][start:end].splitlines()]


def packed(html):
    """Lines with runs of blanks as one '' and none at the ends."""
    text = re.sub(r"\n{2,}", "\n\n", "\n".join(lines(html)).strip("\n"))
    return text.split("\n")


def test_br_and_blocks_leave_blank_lines_and_inline_tags_do_not():
    assert packed("<article>A<br>B</article>") == ["A", "", "B"]
    assert packed("<article><b>A</b>B</article>") == ["A", "B"]
    assert packed("<article><p>A</p><p>B</p></article>") == ["A", "", "B"]
    assert packed("<article>A<!-- x -->B</article>") == ["A", "B"]


def test_dropped_elements_vanish_with_their_content():
    html = "<article>A<script>x<b>y</b></script><nav>n<p>m</p></nav><div class='a RawHtmlModule'>r</div>B</article>"
    assert packed(html) == ["A", "B"]


def test_stray_and_unclosed_tags():
    assert packed("<article>A</i>B<p>C<p>D</article>E") == ["AB", "", "C", "", "D"]
    assert packed("<article>A</br>B<br></br>C</article>") == ["AB", "", "C"]


def test_character_references():
    assert packed("<article>&amp;amp; &#65;&#x42; &copy; &nbsp;x &unknown; &#150;</article>") == [
        "&amp; AB © \xa0x &unknown –"
    ]


def test_opaque_text_is_no_text():
    walk = PageWalk("<div>a<template>b<i>c</i></template><style>d</style><ruby>e<rt>f</rt></ruby></div>")
    assert walk.text == "a e"


def test_container_order():
    html = (
        "<main id=m><article id=a><div class='RichTextModule' id=r1></div><p class='RichTextArticleBody-body' id=b></p>"
        "<div class='RichTextModule RichTextArticleBody' id=r2></div></article></main>"
        "<section id=s>Follow <b>us</b> on facebook<div id=d>Follow us</div></section>"
    )
    assert [n.attrs["id"] for n in found(html)] == ["b", "r2", "r1", "a", "m", "s"]


def test_deep_unclosed_nesting_is_linear():
    walk = PageWalk("<article>" + "<p>x" * 20_000)
    assert len(walk.elements) == 20_001 and walk.elements[1].end == len(walk.tokens) - 1


def page_incidents(spark, *htmls):
    pages = spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(htmls)], "url string, html string")
    rows = G.explode_incidents(I.page_incidents(pages)).orderBy("url", "incident_no").collect()
    out = {f"u{i}": [] for i in range(len(htmls))}
    for r in rows:
        out[r.url].append((r.incident_type, r.incident_text))
    return list(out.values())


def test_pages_to_incidents(spark):
    block = "<main><p><b>Theft:</b>A bike&nbsp; was taken.</p><p><b>Lost Item</b>A bag.</p></main>"
    flat = "<main><h3>Theft</h3><p>A bike was taken.</p><p>It was red.</p><h3>Alarm</h3></main>"
    paragraphs = (
        "<main><nav><p>In the menu.</p></nav><p>First.<p>Second.</p><p>Police Beat</p>"
        "<p>Follow us on Facebook</p><p>After it.</p></main>"
    )
    # the first paragraph is never closed, so it runs on and holds the marker
    nothing = "<main>   </main>"
    ties = "<main><article><p><b>Theft</b>A bike.</p></article></main>"
    assert page_incidents(spark, block, flat, paragraphs, nothing, ties) == [
        [("Theft", "A bike was taken."), ("Lost Item", "A bag.")],
        [("Theft", "A bike was taken. It was red.")],
        [("", "In the menu."), ("", "Second."), ("", "After it.")],
        [],
        [("Theft", "A bike.")],
    ]


def test_a_marker_inside_a_paragraph_drops_only_that_paragraph(spark):
    html = "<article><p>One.</p><p>See us: Follow us on Facebook</p><p>Two.</p></article>"
    assert page_incidents(spark, html) == [[("", "One."), ("", "Two.")]]


LIST_PAGE = """
<div class="ListImageSmall-items-item x"><h3 class="PromoImageSmall-title"><a href="/b/1?x=1&amp;y=2"> Police  Beat • 06/01/2026 </a></h3>
<div class="PromoImageSmall-nameAndDate"><span>by</span><i class="date">June 2,\n 2026</i></div></div>
<div class="ListImageSmall-items-item"><a href="n">Other</a><a href="../b/2">Police <b></b>Beat</a><a href="b/3"><b>police beat 06/03/2026 06/04/2026</b></a></div>
<div class="ListImageSmall-items-item"><h3 class="PromoImageSmall-title"><a href="/c">Campus News</a></h3></div>
<div class="ListImageSmall-items-item"><h3 class="PromoImageSmall-title"><a>Police Beat</a></h3></div>
<div class="other"><h3 class="PromoImageSmall-title"><a href="/d">Police Beat - 06/05/2026</a></h3></div>
<button class="List-paginationButton" data-url="?p=0">Previous</button>
<button class="List-paginationButton" data-url="?p=2">NEXT page</button><a href="/last">next</a>
"""


def test_list_page(spark):
    pages = spark.createDataFrame(
        [(1, "https://h.example/list/", LIST_PAGE), (2, "https://h.example/list/?p=2", "<a href='nexus'>Nextdoor</a>")],
        "page_no int, url string, html string",
    )
    rows = H.extract_list_items(pages).orderBy("page_no", "item_no").collect()
    assert [(r.url, r.title, r.published_at, r.date_range_raw, r.is_multi_date_beat) for r in rows] == [
        ("https://h.example/b/1?x=1&y=2", "Police Beat • 06/01/2026", "June 2, 2026", "06/01/2026", False),
        ("https://h.example/list/b/3", "police beat 06/03/2026 06/04/2026", "", "06/03/2026 - 06/04/2026", True),
    ]
    nexts = {r.page_no: r.next_page_url for r in H.scan_list_pages(pages).collect()}
    assert nexts == {1: "https://h.example/list/?p=2", 2: None}


def test_raw_documents_from_pages(spark):
    lists = spark.createDataFrame(
        [(1, "https://h.example/", LIST_PAGE), (2, "https://h.example/", LIST_PAGE)], "page_no int, url string, html string"
    )
    details = spark.createDataFrame(
        [
            ("https://h.example/b/1?x=1&y=2", "<main><p><b>Theft</b>A bike.</p><p><b>Alarm</b>A bell.</p></main>"),
            ("https://h.example/unlisted", "<main><p><b>Theft</b>A car.</p></main>"),
        ],
        "url string, html string",
    )
    raw = I.raw_from_pages(lists, details, F.timestamp_seconds(F.lit(0)))
    rows = raw.orderBy("incident_type").collect()
    assert [(r.incident_type, r.incident_text, r.beat_published_at, r.normalized) for r in rows] == [
        ("Alarm", "A bell.", "June 2, 2026", False),
        ("Theft", "A bike.", "June 2, 2026", False),
    ]
    assert [str(d) for d in rows[0].incident_dates] == ["2026-06-01"]
    assert all(r.location_zone is None and len(r.raw_text_hash) == 64 for r in rows)


def test_open_items_and_wrappers_cost_linear_time(spark):
    """Items and containers that are never closed hold all that follow them."""


    item = "<div class='ListImageSmall-items-item'><h3 class='PromoImageSmall-title'><a href='/r/{i}'>Police Beat {i}</a></h3>"
    page = "".join(item.replace("{i}", str(i)) for i in range(800))
    walk = PageWalk(page)
    began = time.perf_counter()
    items = list(H._list_items(walk, "https://x.example/"))
    assert H._next_page(walk, "https://x.example/") is None
    assert time.perf_counter() - began < 0.5
    assert [i["url"] for i in items] == [f"https://x.example/r/{i}" for i in range(800)]

    nested = "<main>" + "<div>" * 1000 + "Theft<p>A bag went missing.</p> Follow us on Facebook"
    found = H.extract_containers(spark.createDataFrame([("u", nested)], "url string, html string")).collect()
    assert len(found) <= 2 and all("A bag" in r.raw_text for r in found)


def plain_lines(walk, node):
    """The text of one element by a walk of its own."""
    pieces, joinable, gone = [], False, 0
    for kind, value in walk.tokens[node.start : node.end]:
        if kind in (OPEN, CLOSE) and H._dropped(value):
            gone += 1 if kind == OPEN else -1
            joinable = False
        elif not gone and kind == TEXT:
            pieces[len(pieces) - joinable :] = [pieces[-1] + value if joinable else value]
            joinable = True
        elif not gone:
            joinable = False
            if kind in (OPEN, CLOSE) and (value.name in H.BLOCKS or (value.name, kind) == ("br", OPEN)):
                pieces.append("\n")
    return "\n".join(pieces)


def test_ranges_are_the_texts_of_single_walks(spark):
    pick = random.Random(6)
    dropped = [f"<{t}>" for t in sorted(H.DROPPED_TAGS)] + [f"<i class='{c}'>" for c in sorted(H.DROPPED_CLASSES)]
    parts = ["<div>", "<p>", "</p>", "</div>", "<br>", "<b>", "</b>", "é𝄞 ", "Follow us on Facebook", "a\nb", "<!-- x -->", "&amp;"]
    parts += ["<article>", "</article>", "<main>", "<section>", "<article class='x y'>", "</i>", *dropped]
    parts += [f"</{t}>" for t in sorted(H.DROPPED_TAGS)]
    pages = [(f"u{i}", "".join(pick.choice(parts) for _ in range(pick.randrange(60)))) for i in range(150)] + [("none", None)]
    got = {}
    for r in H.extract_containers(spark.createDataFrame(pages, "url string, html string")).collect():
        got.setdefault(r.url, {})[r.candidate_no] = r
    deep = 0
    for url, html in pages:
        walk = PageWalk(html or "")
        wanted = found(html or "")
        assert set(got.get(url, {})) <= set(range(len(wanted))) and bool(wanted) == (url in got)
        for number, r in got.get(url, {}).items():
            node = wanted[number]
            assert r.raw_text == plain_lines(walk, node) and r.flat_text == walk.text
            inside = [e for e in walk.elements if e.name == "p" and node.start < e.start < node.end]
            assert [r.flat_text[s.start : s.start + s.length] for s in r.paragraph_spans] == [walk.text_of(e) for e in inside]
            deep += len(H.DROPPED_TAGS) > 0 and any(H._dropped(e) and e.start < node.start < e.end for e in walk.elements)
    assert deep and sum(map(len, got.values())) > 100


def test_output_is_linear_where_each_level_adds_a_word(spark):
    nested = lambda n: "<main>" + "".join(f"<div>word{i} " for i in range(n)) + "Follow us on Facebook"
    pages = [(str(n), nested(n)) for n in (500, 1000, 2000)]
    frame = H.scan_pages(spark.createDataFrame(pages, "url string, html string"))
    size = {r.url: sum(map(len, r.layers)) + len(r.text) + 8 * len(r.containers) for r in frame.collect()}
    assert all(len(r.containers) > 500 for r in frame.where("url = '1000'").collect())
    assert size["2000"] < 4.5 * size["500"] and size["2000"] < 4 * len(pages[2][1])
    # and each container still has its own text
    rows = H.extract_containers(spark.createDataFrame(pages[:1], "url string, html string")).orderBy("candidate_no").collect()
    assert len({r.raw_text for r in rows}) == len(rows) == 500  # the first div holds all that main does


ODD = ["<div>", "</div>", "<p>", "</p>", "<br/>", "<br>", "</br>", "a\nb", "&amp;", "&nbsp", "& ", "&", "&#", "&#65;", "&#x41", "&zz;", "&a-b;", "<!-- x -->"]
ODD += ["<!--", "<!doctype html>", "<?xml a?>", "<?", "<![CDATA[x<y]]>", "</>", "</ p>", "<", "<1", ">", "<script>", "</script>", "<script src='a'>'<p>'</Script >"]
ODD += ["<a href='/x?z=1'>", '<a HREF="a&amp;b" class=" c  d ">', "<a href=x>", "<a  href = 'q' >", "<a b='", "<a b='x'c>", "<a/b>", "<é>", "</a>", "\x00", "<style/>"]


def test_plain_markup_gives_the_events_of_the_parser():
    """The short way through plain markup and the library's own loop walk alike."""

    class Slow(PageWalk):
        def goahead(self, end):
            HTMLParser.goahead(self, end)

    def seen(walk):
        marks = [(e.name, e.attrs, e.classes, e.parent and e.parent.order, e.start, e.end) for e in walk.elements]
        return marks, [(kind, value if kind == TEXT else value and value.order) for kind, value in walk.tokens], walk.text

    pick = random.Random(3)
    for _ in range(3000):
        html = "".join(pick.choice(ODD) for _ in range(pick.randrange(20)))
        assert seen(PageWalk(html)) == seen(Slow(html)), html


def test_plain_markup_does_not_go_through_the_parser(monkeypatch):
    """A list page of thousands of items asks the library's loop and link resolver nothing per tag."""
    asked = []
    monkeypatch.setattr(HTMLParser, "parse_starttag", lambda self, at: asked.append(at))
    monkeypatch.setattr(H, "urljoin", lambda base, link: asked.append(link) or urljoin(base, link))
    item = "<div class='ListImageSmall-items-item'><h3 class='PromoImageSmall-title'><a href='/r/{}'>Police Beat &amp; {}</a></h3></div>"
    items = list(H._list_items(PageWalk("".join(item.format(i, i) for i in range(2000))), "https://plain.example/list"))
    assert [i["url"] for i in items] == [f"https://plain.example/r/{i}" for i in range(2000)] and len(asked) <= 1


def test_plain_links_are_resolved_as_urljoin_does():
    links = ["/x", "/x/", "a/b.html", "a/b/", "?x=1", "/a?b=1&c=2", "", "/", "//h/x", "../a", "./a", "a/../b", "/a//b", "#f", "?", "/a?", "a:b", "a;b", "..", "a..b", "/.a", "%41", " a", "é"]
    bases = ["https://h.example/list/", "https://h.example", "http://h/a/b?c#d", "", "a/b", "mailto:x@y", "http://h/a/../b/", "http://h/a;p", "//h/z", "http://h//a//b"]
    assert all(H._joined(base, link) == urljoin(base, link) for base in bases for link in links)
