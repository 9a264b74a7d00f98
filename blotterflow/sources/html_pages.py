"""HTML scans (S1, S2): pages in, rows of text out.

Only finding the containers needs Python. A task gets ``(url, html)`` Arrow
batches and gives back the texts of each page, and where its containers lie in them;
cutting out, splitting, cleaning and segmenting is Catalyst's work. Output is flushed by size, so one
batch of large pages never becomes one huge Arrow batch.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from blotterflow import config as C
from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.functions.dates import date_range, is_multi_date
from blotterflow.functions.text import collapse_ws
from blotterflow.operators.segment import unfold
from blotterflow.schemas import LIST_PAGES, PAGE_TEXTS
from blotterflow.sources.html_walk import PageWalk, Selector, containers

FLUSH_CHARS = 8 << 20
# a path and a query with nothing to resolve in them: no scheme, host, dot part or empty part
PLAIN_LINK = re.compile(
    r"(?:/?[a-zA-Z0-9_-][a-zA-Z0-9_.-]*(?:/[a-zA-Z0-9_-][a-zA-Z0-9_.-]*)*/?)?(?:\?[a-zA-Z0-9_=&%.+-]+)?"
)

CONTAINER = tuple(Selector(s) for s in C.CONTAINER_SELECTORS)
DROPPED_TAGS = frozenset(s for s in C.DROPPED_SELECTORS if not s.startswith("."))
DROPPED_CLASSES = frozenset(s[1:] for s in C.DROPPED_SELECTORS if s.startswith("."))
BLOCKS = frozenset(C.BLOCK_TAGS)
LIST_ITEM = Selector(C.LIST_ITEM_SELECTOR)
LIST_TITLE = Selector(C.LIST_TITLE_SELECTOR)
DATE_BOX = Selector(C.LIST_DATE_BOX_SELECTOR)
BOXED_DATE, PLAIN_DATE = (Selector(s) for s in C.LIST_DATE_SELECTORS)
NEXT_BUTTON = Selector(C.LIST_NEXT_BUTTON_SELECTOR)


def _batches(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Group ``(row, weight)`` pairs into record batches of bounded weight."""
    pending, weight = [], 0
    for row, cost in rows:
        pending.append(row)
        weight += cost
        if weight >= FLUSH_CHARS:
            yield pa.RecordBatch.from_pylist(pending, schema=schema)
            pending, weight = [], 0
    if pending:
        yield pa.RecordBatch.from_pylist(pending, schema=schema)


def _dropped(node) -> bool:
    return node.name in DROPPED_TAGS or not DROPPED_CLASSES.isdisjoint(node.classes)


def _ranges(walk: PageWalk, found: list, spans: list, paragraphs: list) -> Iterator[dict]:
    """The ranges of each container; a wrapper of the same text and paragraphs is left out."""
    dropped = walk.depths(_dropped)
    wrapped = walk.depths(lambda e: e.name == "p")
    starts = [p.start for p in paragraphs]
    seen = set()
    for number, node in enumerate(found):
        base, end = walk.text_span(node)
        # it would give the same incidents, and ties go to the first
        same = (base, end, dropped[node.order], wrapped[node.order])
        if same in seen:
            continue
        seen.add(same)
        layer, raw, raw_end = spans[node.order]
        first = bisect_right(starts, node.start)
        yield {
            "candidate_no": number,
            "layer": layer,
            "raw_start": raw,
            "raw_length": raw_end - raw,
            "first_paragraph": first,
            "n_paragraphs": max(bisect_left(starts, node.end) - first, 0),
        }


def scan_pages(pages: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per page: its texts once, its content containers as ranges of them.

    Output is linear in the page, however its containers hold one another.
    """
    marker = re.compile(cfg.marker_pattern, re.IGNORECASE)
    schema = to_arrow_schema(PAGE_TEXTS)

    def rows(batches):
        for batch in batches:
            for url, html in zip(*(c.to_pylist() for c in batch.columns)):
                walk = PageWalk(html or "")
                layers, spans = walk.lines(_dropped, BLOCKS)
                paragraphs = [e for e in walk.elements if e.name == "p"]
                found = containers(walk, CONTAINER, C.MARKED_CONTAINER_TAGS, marker)
                yield {
                    "url": url,
                    "layers": layers,
                    "text": walk.text,
                    "paragraphs": [{"start": a, "length": b - a} for a, b in map(walk.text_span, paragraphs)],
                    "containers": list(_ranges(walk, found, spans, paragraphs)),
                }, sum(map(len, layers)) + len(walk.text) + 8 * len(found)

    return pages.select("url", "html").mapInArrow(
        lambda batches: _batches(rows(batches), schema), PAGE_TEXTS
    )


def extract_containers(pages: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per content container of each page.

    ``raw_text`` holds the text nodes by line, cut out of what ``scan_pages`` gives
    once per page. ``flat_text`` is the page's text on one line, in which
    ``paragraph_spans`` mark the container's ``<p>`` elements: nested paragraphs
    overlap, and spans keep them from being copied.
    """
    c = F.col("c")
    return (
        scan_pages(pages, cfg)
        .withColumn("c", F.explode("containers"))
        .select(
            "url",
            c["candidate_no"].alias("candidate_no"),
            F.substring(F.element_at("layers", c["layer"] + 1), c["raw_start"] + 1, c["raw_length"]).alias("raw_text"),
            F.col("text").alias("flat_text"),
            F.slice("paragraphs", c["first_paragraph"] + 1, c["n_paragraphs"]).alias("paragraph_spans"),
        )
    )


@lru_cache(maxsize=1024)
def _stem(page_url: str, sample: str) -> str:
    return urljoin(page_url, sample).removesuffix(sample)


def _joined(page_url: str, link: str) -> str:
    """``urljoin``; what a page's plain links have in common is worked out once."""
    if not (link and PLAIN_LINK.fullmatch(link)):
        return urljoin(page_url, link)
    return _stem(page_url, "/x" if link[0] == "/" else "?x" if link[0] == "?" else "x") + link


def _list_items(walk: PageWalk, page_url: str) -> Iterator[dict]:
    """The link and the date of each item: the first ones that start inside it.

    Candidates are gathered once, in document order, and each item looks its own up by
    position: open items that hold one another cost no more than others.
    """
    items = walk.matching(LIST_ITEM)
    if not items:
        return
    titled, boxed = (walk.depths_in(walk.matching(around)) for around in (LIST_TITLE, DATE_BOX))
    links = [e for e in walk.elements if e.name == "a" and "href" in e.attrs]
    dated = {e.order: e for e in walk.matching(BOXED_DATE) if boxed[e.order]}
    dated |= {e.order: e for e in walk.matching(PLAIN_DATE)}

    def finder(candidates):
        starts = [e.start for e in candidates]

        def first(item):
            at = bisect_right(starts, item.start)
            return candidates[at] if at < len(candidates) and starts[at] < item.end else None

        return first

    in_title, date_of = finder([e for e in links if titled[e.order]]), finder([dated[i] for i in sorted(dated)])
    by_text = None
    for item in items:
        link = in_title(item)
        if link is None:
            if by_text is None:
                wanted = re.compile(C.LINK_TEXT_PATTERN, re.IGNORECASE)
                by_text = finder([e for e in links if wanted.search(walk.sole_string(e) or "")])
            link = by_text(item)
        if link is not None and link.attrs["href"]:
            date = date_of(item)
            yield {
                "url": _joined(page_url, link.attrs["href"]),
                "title": walk.text_of(link),
                "published_at": walk.text_of(date) if date else "",
            }


def _next_page(walk: PageWalk, page_url: str) -> str | None:
    marks = [m.span() for m in re.finditer(C.NEXT_TEXT_PATTERN, walk.text, re.IGNORECASE)]
    if not marks:
        return None
    buttons = [(e, e.attrs["data-url"]) for e in walk.matching(NEXT_BUTTON) if "data-url" in e.attrs]
    links = [(e, e.attrs["href"]) for e in walk.elements if e.name == "a" and "href" in e.attrs]
    for node, target in buttons + links:
        if walk.holds(node, marks):
            return _joined(page_url, target)
    return None


def scan_list_pages(pages: DataFrame) -> DataFrame:
    """One row per list page: its items and the URL of the next page.

    ``pages`` has ``page_no``, ``url`` and ``html``.
    """
    schema = to_arrow_schema(LIST_PAGES)

    def rows(batches):
        for batch in batches:
            for page_no, page_url, html in zip(*(c.to_pylist() for c in batch.columns)):
                walk = PageWalk(html or "")
                yield {
                    "page_no": page_no,
                    "page_url": page_url,
                    "next_page_url": _next_page(walk, page_url),
                    "items": list(_list_items(walk, page_url)),
                }, len(walk.text)

    return pages.select(F.col("page_no").cast("bigint"), "url", "html").mapInArrow(
        lambda batches: _batches(rows(batches), schema), LIST_PAGES
    )


def extract_list_items(pages: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per report link, with its title's date range.

    Titles are cleaned before items are unfolded: the filter on them would repeat it.
    """
    cleaned = F.transform("items", lambda i: i.withField("title", collapse_ws(i.title)))
    return (
        unfold(
            scan_list_pages(pages).select("page_no", "next_page_url", cleaned.alias("items")),
            "items", "item_no", "item",
        )
        .select(
            "page_no",
            "item_no",
            F.col("item.url").alias("url"),
            F.col("item.title").alias("title"),
            collapse_ws(F.col("item.published_at")).alias("published_at"),
            "next_page_url",
        )
        .filter(F.lower("title").startswith(cfg.title_prefix))
        .withColumn("date_range_raw", date_range(F.col("title"), cfg))
        .withColumn("is_multi_date_beat", is_multi_date(F.col("date_range_raw")))
    )
