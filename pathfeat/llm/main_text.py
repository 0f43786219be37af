"""The main text of web pages from text-to-tag ratios.

The events of the standard library's parser are read once. They cut a page into lines,
one per block of text, each with the tags that opened or closed in it, the text in links
and the elements around it. A line's ratio is its text outside links by its tags, zero
inside menus, forms, adverts and the like, known by tag, role, class or id. The logarithms of
the ratios are smoothed with a Gaussian kernel and split at a threshold between the weak and
the strong cluster.

The region is the innermost block that holds nearly all text of strong lines, or half of
it if it is an article or main element, with its like-named siblings that hold content;
its lines belong to it however short they are. Where no tag says that the region is
content, blocks without a strong line at its edges, and those of links, go.

Defined results: null, empty and text-free pages have an empty text; unclosed and stray
tags are borne with; a null id stays null; repeated rows are read each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import column, schema_after

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr label img".split()
)
_ASIDE = frozenset(
    "nav header footer aside form script style noscript template head title button select option "
    "textarea svg canvas iframe object dialog menu audio video map datalist".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar tablist".split()
)
# Words of a class or id that mark what isn't the article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment "
    "comments disqus reply replies respond widget toolbar pagination pager skip search toc "
    "hidden copyright legal disclaimer".split()
)
_WORDS = re.compile(r"[a-z]+")
# Elements that a start tag of the same group closes if they are still open.
_CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
_CLOSES |= dict.fromkeys(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol pre section table ul".split(),
    {"p"},
)
_WALLS = frozenset("article main section div table ul ol dl nav aside body blockquote".split())


# Blocks that can be a region, and those whose tag says that they are content.
_HOLDERS = _WALLS | frozenset("html form header footer fieldset details li td th dd tr figure center span".split()) | {""}
_CONTENT = ("article", "main")
_SHARE, _SHARE_OF_CONTENT, _SHARE_OF_TWIN = 0.8, 0.5, 0.1
# Of the threshold between unsmoothed ratios, what a line must reach.
_CLEAR = 0.75


class _Node:
    __slots__ = ("tag", "up", "aside", "void", "weight", "strong", "content", "names", "down")

    def __init__(self, tag: str, up: _Node | None, aside: bool, names: str = "") -> None:
        self.tag, self.up, self.aside, self.names = tag, up, aside, names
        self.void = self.strong = self.content = False
        self.weight = 0
        self.down: list[_Node] = []
        if up is not None:
            up.down.append(self)


@dataclass
class _Line:
    """A block's text, how much of it is in links, its tags, and where it starts."""

    text: str
    linked: int
    tags: int
    node: _Node

    @property
    def ratio(self) -> float:
        return max(0, len(self.text) - self.linked) / max(1, self.tags)


class _Lines(HTMLParser):
    """The lines of a page, from the events of the parser."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = _Node("", None, False)
        self.at = self.top
        self.lines: list[_Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        self.line_node = self.top

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(_Line(text, self.linked, self.tags, self.line_node))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag in _VOID:
            if tag not in _INLINE:
                self.flush()
            return
        if tag not in _INLINE:
            self.flush()
        closes = _CLOSES.get(tag)
        if closes:
            self._close(closes)
        self.links += tag == "a"
        node = _Node(tag, self.at, tag in _ASIDE, next((v or "" for k, v in attrs if k == "class"), ""))
        if tag in _CONTENT:
            # What holds the article is no advert, whatever its class says.
            up = self.at
            while up is not None:
                up.void = up.void or (up.aside and up.tag not in _ASIDE)
                up = up.up
        elif attrs and not node.aside and tag not in ("html", "body"):
            node.aside = _marked(attrs)
        self.at = node

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag not in _INLINE:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in _INLINE:
            self.flush()
            self.links = 0
        elif tag == "a":
            self.links = max(0, self.links - 1)
        node = self.at
        while node.up is not None:
            if node.tag == tag:
                self.at = node.up
                return
            # Only an element that can hold blocks ends blocks inside it.
            if node.tag in _WALLS and tag not in _WALLS and tag not in _ASIDE and tag != "html":
                return
            node = node.up

    def _close(self, tags: set[str]) -> None:
        node = self.at
        while node.up is not None and node.tag not in _WALLS:
            if node.tag in tags:
                self.at = node.up
            node = node.up

    def handle_data(self, data: str) -> None:
        if not self.parts:
            self.line_node = self.at
        self.parts.append(data)
        if self.links:
            self.linked += len(" ".join(data.split()))


def _marked(attrs) -> bool:
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if value and name == "role" and value.strip().lower() in _ROLES:
            return True
        if value and name in ("class", "id") and not _MARKS.isdisjoint(_WORDS.findall(value.lower())):
            return True
        if value and name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _above(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.up


def _smoothed(values: list[float], sigma: float) -> list[float]:
    reach = max(1, int(3 * sigma))
    kernel = [exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        lo = max(0, i - reach)
        hi = min(len(values), i + reach + 1)
        weights = kernel[lo - i + reach : hi - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


def _threshold(values: list[float]) -> float:
    """Between the means of a weak and a strong cluster, found by moving it until it stays."""
    low, high = min(values), max(values)
    cut = (low + high) / 2
    for _ in range(20):
        weak = [v for v in values if v < cut]
        strong = [v for v in values if v >= cut]
        if not weak or not strong:
            break
        new = (sum(weak) / len(weak) + sum(strong) / len(strong)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    lines = page.lines
    usable = [not any(n.aside and not n.void for n in _above(line.node)) for line in lines]
    if not any(usable):
        # Marks on everything say nothing; tags still do.
        usable = [not any(n.tag in _ASIDE for n in _above(line.node)) for line in lines]
    if not any(usable):
        return ""
    own = [log1p(line.ratio) if ok else 0.0 for line, ok in zip(lines, usable)]
    smooth = _smoothed(own, sigma)
    cut = _threshold(smooth)
    # A line that smoothing alone lifts isn't content.
    least = _CLEAR * _threshold(own)
    clear = [ok and v >= least for ok, v in zip(usable, own)]
    strong = [c and s >= cut for c, s in zip(clear, smooth)]
    if not any(strong):
        strong = clear if any(clear) else usable
    for i, line in enumerate(lines):
        for node in _above(line.node):
            node.weight += len(line.text) * strong[i]
            node.strong = node.strong or strong[i]
            node.content = node.content or clear[i]
    region = _region(lines, strong)
    regions = {region, *_twins(region)}
    inside = [i for i, line in enumerate(lines) if usable[i] and any(n in regions for n in _above(line.node))]
    if not any(n.tag in _CONTENT for n in _above(region)):
        inside = _without_edges(lines, inside, strong, regions)
    return " ".join(lines[i].text for i in inside)


def _region(lines: list[_Line], strong: list[bool]) -> _Node:
    """The innermost block that holds nearly all text of strong lines, half of it if its
    tag says that it is content; of such ones around one another with the same strong
    text the outermost, as that holds their short lines too."""
    total = sum(len(line.text) for line, good in zip(lines, strong) if good)
    best, depth = None, -1
    for line, good in zip(lines, strong):
        chain = [*_above(line.node)] if good else []
        for i, node in enumerate(chain):
            share = _SHARE_OF_CONTENT if node.tag in _CONTENT else _SHARE
            if len(chain) - i > depth and node.tag in _HOLDERS and node.weight >= share * total:
                best, depth = node, len(chain) - i
    for node in _above(best):
        if node.tag in _CONTENT and node.weight == best.weight:
            best = node
    return best


def _twins(region: _Node) -> Iterator[_Node]:
    """Siblings of the region's kind that hold content; if the tag doesn't say that it is
    content, they must hold a tenth of the region's strong text."""
    told = region.tag in _CONTENT
    for node in region.up.down if region.up else ():
        alike = node is not region and (node.tag, node.names) == (region.tag, region.names)
        if alike and node.content and (told or node.weight >= _SHARE_OF_TWIN * region.weight):
            yield node


def _without_edges(lines: list[_Line], inside: list[int], strong: list[bool], regions: set[_Node]) -> list[int]:
    """Lines of a region whose tag says nothing. Blocks inside it that hold no strong line
    go if they lie before the first or after the last strong one, or are mostly links;
    its own lines and paragraphs stay however short they are."""
    marks = [i for i in inside if strong[i]]
    kept = []
    for i in inside:
        below = None
        for node in _above(lines[i].node):
            if node in regions:
                break
            if node.tag in _HOLDERS:
                below = node
        edge = not marks[0] < i < marks[-1] or 2 * lines[i].linked > len(lines[i].text)
        if below is None or below.strong or not edge:
            kept.append(i)
    return kept


def main_texts(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``key, url, text, n_chars`` of every page."""
    source = pages.select(
        F.struct(column(pages, key), column(pages, url)).alias("row"), column(pages, html, "html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["row", "text", "n_chars"],
            )

    schema = schema_after(source.schema["row"], "text string, n_chars bigint")
    found = source.mapInArrow(run, schema)
    return found.select(
        F.col("row")[key].alias(key), F.col("row")[url].alias(url), "text", "n_chars"
    )
