"""Operator 11: main text of HTML pages by tree scoring.

A page is read once into a tree of block elements; its text becomes blocks in page
order, so that every element holds one run of them.  Elements that are no part of an article
by their tag, role or name (menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
comments of readers, hidden parts) give no blocks.  Every paragraph then passes points for
its length and its commas to its ancestors, less from level to level; an element's points are
discounted by the share of its text that is link text.  The element with the most points
is the container; it is kept with those of its siblings that look like it.

Pages are independent of each other: the work is one pass over the rows, without a shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import table

#: Characters of text that go to one batch of results.
BATCH_CHARS = 1 << 21
#: Levels of ancestors that get points of a paragraph, and their shares.
SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: Of the container's points, what a sibling needs to be kept with it.
SIBLING_SHARE = 0.2
#: Link text in a list, table or section of at least so many blocks that makes it a menu.
MENU_SHARE, MENU_BLOCKS = 0.6, 2

# ---- fixed values: elements of HTML ------------------------------------------
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr acronym b basefont bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby
    s samp small span strike strong sub sup time tt u var wbr""".split())
#: Their content is text without markup.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Their start closes an open paragraph.
_ENDS_P = frozenset("""address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An end tag or an implied end reaches no further up than these.
_SCOPE = frozenset("caption table td th".split())
#: What the start of an element ends, and how far up.
_IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ol ul menu article section table td th aside nav main".split())),
    "dd": (frozenset(["dd", "dt"]), frozenset("dl article section table td th".split())),
    "dt": (frozenset(["dd", "dt"]), frozenset("dl article section table td th".split())),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    **{t: (frozenset("thead tbody tfoot".split()), frozenset(["table"])) for t in ("thead", "tbody", "tfoot")},
}
_TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())

# ---- fixed values: what is no part of an article ----------------------------
_OTHER_TAGS = frozenset("""nav footer aside script style template noscript iframe button select option datalist input textarea svg math canvas
    object embed applet audio video map dialog menu""".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar tablist form".split())
_OTHER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsbygoogle adslot adbox adunit adwrap banner
    sponsor sponsors sponsored promo promos promotion promotions promoted cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe subscription signup login paywall share sharing social comment comments disqus respond replies discussion
    related recommended recommendations sidebar sidebars aside widget widgets menu menus nav navbar navigation navigations breadcrumb
    breadcrumbs pagination pager footer footers masthead toolbar skip""".split())
#: A name with one of these says what the rest of the page has, or is a state.
_SAID_OF_OTHERS = frozenset("has with no without not hasnt open enabled closed disabled".split())
_ARTICLE_NAMES = frozenset("article content post entry story body text main".split())

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in _RAW}
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """A block element; its text is the blocks ``first`` to ``end``."""
    __slots__ = ("tag", "names", "parent", "children", "first", "end", "dropped", "header", "article", "inside", "points")

    def __init__(self, tag: str, parent: Element | None, first: int, names: str = ""):
        self.tag, self.parent, self.first, self.end, self.names = tag, parent, first, first, names
        self.children: list[Element] = []
        self.dropped = parent.dropped if parent else False
        self.header = parent.header if parent else False
        self.article, self.points = False, 0.0
        self.inside = parent is not None and (parent.inside or parent.article)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _parts(name: str) -> list[str]:
    return [x.lower() for x in _NAME_PART.findall(name)]


def _named(names: list[str]) -> str:
    """'other' if a class or id says that an element is no part of an article, 'header', or nothing."""
    found = ""
    for parts in map(_parts, names):
        if not parts or _SAID_OF_OTHERS.intersection(parts):
            continue
        if _OTHER_NAMES.intersection(parts):
            return "other"
        if "header" in (parts[0], parts[-1]):
            found = "article header" if parts[0] in _ARTICLE_NAMES else "header"
    return found


class _Page:
    """The tree and the blocks of one page."""

    def __init__(self, text: str):
        self.blocks: list[tuple[str, Element, int]] = []  # text, element, characters of link text
        self.root = Element("body", None, 0)
        self.stack, self.open = [self.root], Counter()
        self.pieces: list[str] = []
        self.link_chars, self.link_depth = 0, 0
        self._read(text)
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        self.root.end = len(self.blocks)

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            at = next(e for e in reversed(self.stack) if e.tag not in _INLINE)
            if text and not (at.header and at.tag not in _HEADINGS):
                self.blocks.append((text, at, min(len(text), self.link_chars)))
            self.pieces, self.link_chars = [], 0

    def _pop(self) -> None:
        e = self.stack.pop()
        if e.tag not in _INLINE:
            self._flush_into(e)
        self.open[e.tag] -= 1
        e.end = len(self.blocks)
        if len(self.stack) < self.link_depth:
            self.link_depth = 0

    def _flush_into(self, e: Element) -> None:
        self.stack.append(e)
        self._flush()
        self.stack.pop()

    def _close(self, tags: frozenset, stop: frozenset) -> None:
        """Ends the innermost open element of ``tags``, if none of ``stop`` is above it."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in stop:
                return

    def _read(self, text: str) -> None:
        at, n = 0, len(text)
        while at < n:
            m = _TOKEN.search(text, at)
            stop = m.start() if m else n
            if stop > at and not self.stack[-1].dropped:
                self._text(text[at:stop])
            if not m:
                return
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in _RAW:
                end = _RAW_END[tag].search(text, at)
                at = end.start() if end else n

    def _text(self, raw: str) -> None:
        raw = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(raw)
        if self.link_depth:
            self.link_chars += len(" ".join(raw.split()))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "head", "body") or tag in _RAW or tag == "frameset":
            return
        if tag == "main":
            while self.stack[-1].dropped:
                self._pop()
        inline = tag in _INLINE
        if not inline:
            if tag in _ENDS_P:
                self._close(frozenset(["p"]), _SCOPE)
            if tag in _HEADINGS and self.stack[-1].tag in _HEADINGS:
                self._pop()
            if tag in _IMPLIED:
                self._close(*_IMPLIED[tag])
            self._flush()
        if tag in _VOID:
            if tag == "br" and self.pieces:
                self.pieces.append(" ")
            return
        own = _attributes(attributes) if attributes and not attributes.isspace() else {}
        if tag == "a" and "href" in own and not self.link_depth:
            self.link_depth = len(self.stack)
        e = self._element(tag, own)
        if inline and not (e.dropped and not self.stack[-1].dropped):
            return  # transparent, unless it is left out by itself
        self.stack[-1].children.append(e)
        self.stack.append(e)
        self.open[tag] += 1

    def _element(self, tag: str, own: dict[str, str]) -> Element:
        up = self.stack[-1]
        e = Element(tag, up, len(self.blocks), own.get("class", ""))
        role = own.get("role", "").strip().lower()
        e.article = tag in ("article", "main") or role in ("main", "article") or own.get("itemprop") == "articleBody"
        if e.dropped:
            return e
        said = _named([*own.get("class", "").split(), *own.get("id", "").split(), *([tag] if "-" in tag else [])]) if own or "-" in tag else ""
        hidden = "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(own.get("style", "")) is not None
        if hidden or tag in _OTHER_TAGS or role in _OTHER_ROLES or (said == "other" and tag != "main") or (tag == "label" and self.open["form"]):
            e.dropped = True
        elif tag in ("header", "hgroup") or (said.endswith("header") and tag not in _HEADINGS and not e.article):
            e.dropped = not (e.inside or said == "article header" or tag == "hgroup")
            e.header = True
        return e

    def _end(self, tag: str) -> None:
        if tag == "a" and self.link_depth and self.link_depth <= len(self.stack):
            self.link_depth = 0
        if tag == "br" and self.pieces:
            self.pieces.append(" ")
        if tag in _HEADINGS:
            self._close(_HEADINGS, _SCOPE)
        elif tag in _TABLE_PARTS:
            self._close(frozenset([tag]), frozenset() if tag == "table" else frozenset(["table"]))
        elif self.open[tag]:
            self._close(frozenset([tag]), _SCOPE)
        elif tag not in _INLINE and tag not in ("body", "html", "head"):
            self._flush()


#: Elements whose text is a paragraph of the element around them.
_PARAGRAPHS = frozenset("p pre blockquote li dd dt figcaption caption summary address".split()) | _HEADINGS
#: Passed over on the way up: lists and rows are no containers.
_PASSED = frozenset("li dd dt dl ul ol tr tbody thead tfoot blockquote pre figure figcaption details summary address".split())


def _menus(page: _Page, chars: np.ndarray, links: np.ndarray, keep: np.ndarray) -> None:
    """Clears the blocks of lists, tables and sections that are mostly links, and of forms that don't wrap the page."""
    rest = [page.root]
    while rest:
        e = rest.pop()
        n = chars[e.end] - chars[e.first]
        if e.tag == "form":
            inside = page.blocks[e.first:e.end]
            if sum(b[1].tag == "p" for b in inside) < 3 and not any(b[1].tag == "h1" for b in inside):
                keep[e.first:e.end] = False
                continue
        if e.tag in ("ul", "ol", "dl", "div", "section", "table") and e.end - e.first >= MENU_BLOCKS and links[e.end] - links[e.first] >= MENU_SHARE * n:
            keep[e.first:e.end] = False
            continue
        rest.extend(c for c in e.children if c.end > c.first)


def _score(page: _Page, keep: np.ndarray) -> list[Element]:
    """Passes the points of all paragraphs up; the elements that have some."""
    scored: list[Element] = []
    for i, (text, e, link) in enumerate(page.blocks):
        if not keep[i]:
            continue
        commas = text.count(",") + text.count("，") + text.count("、") + text.count("،")
        points = (len(text) / 100 + (0 if e.tag in _HEADINGS else 1 + commas)) * (1 - link / len(text))
        at = e.parent if e.tag in _PARAGRAPHS and e.parent else e
        level = 0
        while at is not None and level < len(SHARES):
            if at.tag not in _PASSED or at.parent is None:
                if not at.points:
                    scored.append(at)
                at.points += points * SHARES[level]
                level += 1
            at = at.parent
    return scored


def _container(page: _Page, scored: list[Element], chars: np.ndarray, links: np.ndarray) -> Element:
    def weight(e: Element) -> float:
        n = chars[e.end] - chars[e.first]
        named = any(_ARTICLE_NAMES.intersection(_parts(x)) for x in e.names.split())
        return e.points * (1 - (links[e.end] - links[e.first]) / max(n, 1)) * (1.5 if e.article else 1.25 if named else 1)

    for e in scored:
        e.points = weight(e)
    best = max(scored, key=lambda e: e.points)
    own = chars[best.end] - chars[best.first]
    up, wider = best.parent, best
    while up is not None and not best.article:  # an article's title and lead stand beside its body
        if up.article and own >= 0.5 * (chars[up.end] - chars[up.first]):
            wider = up
            break
        up = up.parent
    return wider


def _siblings(page: _Page, best: Element, chars: np.ndarray, links: np.ndarray) -> list[Element]:
    """The container, and of its siblings those with a share of its points, plain paragraphs, and headings right before it."""
    if best.parent is None:
        return [best]
    row, kept = best.parent.children, []
    lead = at = row.index(best)
    while lead and (row[lead - 1].tag in _HEADINGS or row[lead - 1].end == row[lead - 1].first):
        lead -= 1
    for i, e in enumerate(row):
        n = chars[e.end] - chars[e.first]
        if e is best:
            kept.append(e)
        elif not n:
            continue
        elif best.article:
            if e.article and e.names == best.names and e.tag == best.tag and e.points >= SIBLING_SHARE * best.points:
                kept.append(e)
        elif e.points and e.points >= SIBLING_SHARE * best.points:
            kept.append(e)
        elif e.tag == "p" and links[e.end] - links[e.first] < 0.25 * n and (n > 80 or page.blocks[e.end - 1][0][-1:] in ".!?…。"):
            kept.append(e)
        elif lead <= i < at:
            kept.append(e)
    return kept


def main_text(source: str | None) -> str:
    """The main text of one page, its blocks joined by a line feed; empty where there is none.

    Character references are decoded; any run of white space inside a block is one space.
    Open elements end with the page, unknown ones are passed through, and a cut tag
    at the end is left out, so no input raises an error.
    """
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks:
        return ""
    chars = np.concatenate([[0], np.cumsum([len(b[0]) for b in page.blocks])])
    links = np.concatenate([[0], np.cumsum([b[2] for b in page.blocks])])
    keep = np.ones(len(page.blocks), bool)
    _menus(page, chars, links, keep)
    scored = _score(page, keep)
    if not scored:
        return ""
    best = _container(page, scored, chars, links)
    return "\n".join(page.blocks[i][0] for e in _siblings(page, best, chars, links) for i in range(e.first, e.end) if keep[i])


def extract(pages: DataFrame, column: str = "html", carried: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``carried`` of every row of ``pages``, and ``text``, the main text of the
    HTML in ``column``, with ``n_chars``, its code points.

    Every row is worked on by itself: repeated rows and ids give repeated results, null and empty
    pages an empty text; an empty table gives no rows.  Other columns are not read.
    """
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col(f"`{column}`").cast("string").alias("html"))
    n = len(carried)

    def run(batches):
        for b in batches:
            sources, lo, texts, size = b.column(n), 0, [], 0
            for i in range(b.num_rows):
                texts.append(main_text(sources[i].as_py()))
                size += len(texts[-1])
                if size >= BATCH_CHARS or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).slice(lo, len(texts)) for c in range(n)), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                        names=[*(f"c{c}" for c in range(n)), "text", "n_chars"])
                    lo, texts, size = i + 1, [], 0

    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(rows.schema.fields[:n])), "text string", "n_chars long"])
    return rows.mapInArrow(run, schema).toDF(*carried, "text", "n_chars")


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
