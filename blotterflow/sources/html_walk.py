"""One linear walk over a page's markup, used inside the Arrow batch tasks.

The walk keeps a flat token list, never a recursive tree, so a page of
thousands of unclosed tags costs linear time and no deep stack. An end tag
closes up to the nearest open tag of its name and is ignored when there is
none; unclosed tags end with the page.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape
from html.entities import html5
from html.parser import HTMLParser, charref, entityref, starttagopen
from itertools import accumulate

VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source "
    "track wbr basefont bgsound command frame image isindex nextid spacer".split()
)
# the text of these elements is not content
OPAQUE_TAGS = frozenset(("script", "style", "template", "rt", "rp"))

OPEN, CLOSE, TEXT, OTHER = range(4)

# Plain markup, which one match takes: text, an end tag, a start tag with quoted values, a named
# character; or else the first character of what the library's parser is asked about.
PLAIN = re.compile(
    r"([^<&]+)|</([a-zA-Z][a-zA-Z0-9]*)>"
    r"|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_][-a-zA-Z0-9_.:]*(?:=(?:\"[^\"]*\"|'[^']*'))?)*+)[ \t\n\r\f]*(/?)>"
    r"|&([a-zA-Z][a-zA-Z0-9]*);|([<&])"
)
ATTRIBUTE = re.compile(r"([a-zA-Z_][-a-zA-Z0-9_.:]*)(?:=(?:\"([^\"]*)\"|'([^']*)'))?")


class Selector:
    """``tag``, ``.class`` or ``tag.class``."""

    __slots__ = ("tag", "cls")

    def __init__(self, text: str):
        self.tag, _, self.cls = text.partition(".")

    def matches(self, node: Element) -> bool:
        return (not self.tag or self.tag == node.name) and (
            not self.cls or self.cls in node.classes
        )


class Element:
    __slots__ = ("name", "classes", "attrs", "parent", "order", "start", "end")

    def __init__(self, name, attrs, parent, order, start):
        self.name, self.attrs, self.parent, self.order = name, attrs, parent, order
        self.classes = tuple(attrs["class"].split()) if "class" in attrs else ()
        self.start, self.end = start, -1


class PageWalk(HTMLParser):
    """Tokens, elements in document order, and the page's joined text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.tokens: list[tuple] = []  # (kind, element or text)
        self.elements: list[Element] = []
        self._stack: list[Element] = []
        self._open: dict[str, int] = {}
        self._opaque: list[Element] = []
        self._buffer: list[str] = []
        self._void_closed: set[str] = set()
        self._by_class: dict[str, list[Element]] = {}
        self.feed(html)
        self.close()
        self._flush()
        while self._stack:
            self._pop()
        self._join_text()

    def goahead(self, end):
        """The parser's loop: plain markup by one match each, anything else by the parser's own methods.

        The same events as the library gives, in a fraction of the time. What it cannot finish
        is left to its own loop, from there to the end of the page.
        """
        rawdata, at = self.rawdata, 0
        if not end:
            while at < len(rawdata):
                at, left = self._plain(rawdata, at)
                if left:
                    break
            self.rawdata = rawdata[at:]
        super().goahead(end)

    def _plain(self, rawdata: str, at: int) -> tuple[int, bool]:
        """Takes plain markup from ``at`` on and one odd construct; up to where, and is that left to do."""
        buffer, push, close, opaque = self._buffer, self._push, self.handle_endtag, self.CDATA_CONTENT_ELEMENTS
        for m in PLAIN.finditer(rawdata, at):
            kind = m.lastindex
            if kind == 1:
                buffer.append(m[1])
            elif kind == 2:
                close(m[2].lower())
            elif kind == 5:
                tag, held, slash = m.group(3, 4, 5)
                tag, attrs = tag.lower(), {}
                if held:
                    for name, double, single in ATTRIBUTE.findall(held):
                        value = double or single
                        attrs[name.lower()] = unescape(value) if "&" in value else value
                if slash:
                    push(tag, attrs)
                    self._pop()
                elif tag in opaque:
                    return self._odd(rawdata, m.start())
                else:
                    push(tag, attrs)
                    if tag in VOID_TAGS:
                        self._void_end(tag)
            elif kind == 6:
                self.handle_entityref(m[6])
            else:
                return self._odd(rawdata, m.start())
        return len(rawdata), False

    def _odd(self, rawdata: str, at: int) -> tuple[int, bool]:
        """One construct by the parser's own method; opaque text and what has no end are left to its loop."""
        next_one = rawdata[at + 1 : at + 2]
        if rawdata[at] == "&":
            match = (charref if next_one == "#" else entityref).match(rawdata, at)
            if match is None:
                if next_one in ("", "#") or (next_one.isascii() and next_one.isalpha()):
                    return at, True
                self.handle_data("&")
                return at + 1, False
            if next_one == "#":
                self.handle_charref(match.group()[2:-1])
            else:
                self.handle_entityref(match.group(1))
            return match.end() - (not match.group().endswith(";")), False
        if starttagopen.match(rawdata, at):
            done = self.parse_starttag(at)
            if self.cdata_elem and done >= 0:
                found = self.interesting.search(rawdata, done)
                if found is None:
                    return done, True
                self.handle_data(rawdata[done : found.start()])
                done = self.parse_endtag(found.start())
        elif next_one == "/":
            done = self.parse_endtag(at)
        elif rawdata.startswith("<!--", at):
            done = self.parse_comment(at)
        elif next_one == "?":
            done = self.parse_pi(at)
        elif next_one == "!":
            done = self.parse_html_declaration(at)
        elif next_one:
            self.handle_data("<")
            done = at + 1
        else:
            done = -1
        return (at, True) if done < 0 else (done, False)

    # ---- parser events ----------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._push(tag, {key: value or "" for key, value in attrs})
        if tag in VOID_TAGS:
            self._void_end(tag)

    def _void_end(self, tag):
        self._pop()
        self._void_closed.add(tag)

    def handle_startendtag(self, tag, attrs):
        self._push(tag, {key: value or "" for key, value in attrs})
        self._pop()

    def handle_endtag(self, tag):
        if tag in self._void_closed:
            self._void_closed.discard(tag)
            return
        if self._buffer:
            self._flush()
        if self._open.get(tag):
            while self._pop().name != tag:
                pass

    def handle_data(self, data):
        self._buffer.append(data)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            # fixed values: 0x80-0x9F in the wild are Windows-1252 bytes
            text = bytes([code]).decode("windows-1252") if 0x80 <= code < 0xA0 else chr(code)
        except (ValueError, OverflowError, UnicodeDecodeError):
            text = "\N{REPLACEMENT CHARACTER}"
        self._buffer.append(text)

    def handle_entityref(self, name):
        self._buffer.append(html5.get(name + ";", "&" + name))

    def handle_comment(self, data):
        self._other()

    def handle_decl(self, decl):
        self._other()

    def handle_pi(self, data):
        self._other()

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._flush()
            self._buffer.append(data[len("CDATA["):])
            self._flush()
        self._other()

    def updatepos(self, i, j):
        return j  # line numbers are not used

    # ---- token list -------------------------------------------------------
    def _other(self):
        self._flush()
        self.tokens.append((OTHER, None))

    def _flush(self):
        if self._buffer:
            if not self._opaque:
                self.tokens.append((TEXT, "".join(self._buffer)))
            self._buffer.clear()

    def _push(self, tag, attrs):
        if self._buffer:
            self._flush()
        node = Element(tag, attrs, self._stack[-1] if self._stack else None, len(self.elements), len(self.tokens))
        self.tokens.append((OPEN, node))
        self.elements.append(node)
        if node.classes:
            for name in dict.fromkeys(node.classes):
                self._by_class.setdefault(name, []).append(node)
        self._stack.append(node)
        self._open[tag] = self._open.get(tag, 0) + 1
        if tag in OPAQUE_TAGS:
            self._opaque.append(node)

    def _pop(self) -> Element:
        if self._buffer:
            self._flush()
        node = self._stack.pop()
        self._open[node.name] -= 1
        if self._opaque and self._opaque[-1] is node:
            self._opaque.pop()
        self.tokens.append((CLOSE, node))
        node.end = len(self.tokens)
        return node

    # ---- joined text: any element's text is a slice of the page's -----------
    def _join_text(self):
        parts, at = [], 0
        self._text_from = [0] * (len(self.tokens) + 1)  # offset of next text piece
        self._text_to = [0] * (len(self.tokens) + 1)  # end of last text piece before
        last = 0
        for i, (kind, value) in enumerate(self.tokens):
            self._text_from[i], self._text_to[i] = at, last
            if kind == TEXT and (piece := value.strip()):
                parts.append(piece)
                last = at + len(piece)
                at = last + 1
        self._text_from[-1], self._text_to[-1] = at, last
        self.text = " ".join(parts)

    def text_span(self, node: Element) -> tuple[int, int]:
        start = self._text_from[node.start]
        return start, max(start, self._text_to[node.end])

    def text_of(self, node: Element) -> str:
        start, end = self.text_span(node)
        return self.text[start:end]

    def lines(self, dropped, blocks) -> tuple[list[str], list[tuple[int, int, int]]]:
        """Text nodes joined by newlines, with newlines around blocks and for br, without dropped elements.

        What lies in n dropped elements is in the text of layer n, so an element's text is
        one range of one layer: ``(layer, start, end)`` by its order. A dropped element has none.
        """
        pieces: list[list[str]] = [[]]
        joinable = [False]  # is the layer's last piece a text with no tag after it
        spans: list = [None] * len(self.elements)
        depth = 0
        for kind, value in self.tokens:
            mine = pieces[depth]
            if kind == TEXT:
                if joinable[depth]:
                    mine[-1] += value
                else:
                    mine.append(value)
                joinable[depth] = True
                continue
            joinable[depth] = False
            if kind != OTHER and dropped(value):
                depth += 1 if kind == OPEN else -1
                if depth == len(pieces):
                    pieces.append([])
                    joinable.append(False)
                joinable[depth] = False
                continue
            if kind == OPEN:
                spans[value.order] = depth, len(mine), 0
            if kind != OTHER and (value.name in blocks or (kind == OPEN and value.name == "br")):
                mine.append("\n")
            if kind == CLOSE:
                spans[value.order] = *spans[value.order][:2], len(mine)
        starts = [[0, *accumulate(len(piece) + 1 for piece in mine)] for mine in pieces]
        for order, span in enumerate(spans):
            layer, first, end = span or (0, 0, 0)
            begin = starts[layer][first]
            spans[order] = layer, begin, max(begin, starts[layer][end] - 1)
        return ["\n".join(mine) for mine in pieces], spans

    def sole_string(self, node: Element) -> str | None:
        """The text of an element whose only content, at any depth, is one text."""
        low, high = node.start + 1, node.end - 1
        while low < high and self.tokens[low][0] == OPEN and self.tokens[low][1].end == high:
            low, high = low + 1, high - 1
        return self.tokens[low][1] if high - low == 1 and self.tokens[low][0] == TEXT else None

    def depths(self, matches) -> list[int]:
        """How many elements around each element match, by its order; parents stand before children."""
        return self.depths_in([node for node in self.elements if matches(node)])

    def matching(self, selector: Selector) -> list[Element]:
        """The elements of a selector, in document order."""
        return [e for e in (self._by_class.get(selector.cls, ()) if selector.cls else self.elements) if selector.matches(e)]

    def depths_in(self, nodes: list[Element]) -> list[int]:
        """How many of the nodes are around each element, by its order."""
        own, out = [0] * len(self.elements), []
        for node in nodes:
            own[node.order] = 1
        if not nodes:
            return own
        for node in self.elements:
            above = node.parent
            out.append(0 if above is None else out[above.order] + own[above.order])
        return out

    def holds(self, node: Element, marks: list[tuple[int, int]]) -> bool:
        """Whether one of the marked spans of the page's text lies in an element's.

        The first mark in reach is also the first to end.
        """
        start, end = self.text_span(node)
        first = bisect_left(marks, (start, 0))
        return first < len(marks) and marks[first][1] <= end


def containers(walk: PageWalk, selectors, marked_tags, marker: re.Pattern) -> list[Element]:
    """Content containers by selector order, then those that hold the marker."""
    ranked, tags = {}, {selector.tag for selector in selectors}
    for order, node in enumerate(walk.elements):
        if not node.classes and node.name not in tags:
            continue
        ranks = [rank for rank, selector in enumerate(selectors) if selector.matches(node)]
        if ranks:
            ranked[ranks[0], order] = node
    found = {id(node): node for _, node in sorted(ranked.items())}
    marks = [m.span() for m in marker.finditer(walk.text)]
    for node in walk.elements if marks else ():
        if node.name in marked_tags and walk.holds(node, marks):
            found.setdefault(id(node), node)
    return list(found.values())
