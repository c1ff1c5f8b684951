"""Main text of HTML pages: parser events, text-to-tag ratios per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page; block tags and line breaks end lines. A line's ratio is its text per tag; lines in
navigation, headers, footers, asides, notices, adverts, forms, scripts and comments have none. Ratios are smoothed along the
page, and lines above the threshold are seeds. The first content region is the smallest element that holds most seed text (its article,
where most is in one). Seeds outside it make further regions: the largest element around such a seed that does not hold the first region, or
the line alone. The lines of all regions are joined in page order, with the headings before them; nothing is left out but such parts.

Defined cases. Null or empty html, or no text: "" and 0. Broken markup is read as the parser reads it; unclosed elements end with their
parents. Repeated rows: each its own, equal text. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SIGMA = 1.5
THRESHOLD = 0.5  # of the mean smoothed ratio
MOST_OF_SEEDS = 0.9
LINK_SHARE = 0.8

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img picture".split())
SKIPPED = frozenset("head script style noscript template iframe object svg math canvas audio video nav footer aside form button select textarea option dialog menu fieldset title".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEPT_ROOTS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that mark parts around an article.
AROUND = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs
sidebar footer masthead cookie cookies consent notice notices notification alert popup modal overlay newsletter subscribe signup share sharing social comment comments
disqus reply replies respond related recommended recommendations widget pagination pager login toolbar copyright contentinfo complementary search
skip hidden""".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion hidden".split())
HEADERS = frozenset("header site-header page-header global-header top-header siteheader pageheader".split())
LAYOUT = frozenset("has with without no layout wrapper container page".split())

_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[a-z0-9]+")


def is_around(tag: str, attributes: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element is around the article by tag, role, class or id. inside: it stands in an article or main."""
    if tag in SKIPPED or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        return tag == "article" and any(n == "class" and v and set(_PARTS.findall(v.lower())) & {"comment", "reply"} for n, v in attributes)
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if value and name in ("class", "id", "role"):
            for one in value.lower().split():
                if one in HEADERS and not inside:
                    return True
                parts = set(_PARTS.findall(one))
                if parts & AROUND and not parts & LAYOUT:
                    return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def is_concealed(attributes: list[tuple[str, str | None]]) -> bool:
    """Whether an element within a line is hidden or an advert, which takes its words out of the line."""
    given = dict(attributes)
    return ("hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "").lower()
            or not ADVERTS.isdisjoint((given.get("class") or "").lower().split()))


class Lines(HTMLParser):
    """Lines of a page: text, tags, link characters, the path of open elements, and whether they are around the article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool]] = []
        self.open: list[tuple[str, int, bool, bool]] = []
        self.names: dict[int, str] = {}
        self.around = self.links = self.roots = self.hidden = 0
        self.pieces: list[str] = []
        self.tags = self.link_chars = 0

    def cut(self) -> None:
        if self.pieces:
            text = _SPACE.sub(" ", "".join(self.pieces)).strip()
            if text:
                self.lines.append((text, self.tags, self.link_chars, tuple(e[1] for e in self.open if e[0] not in INLINE), self.around > 0))
            self.pieces = []
        self.tags = self.link_chars = 0

    def handle_starttag(self, tag, attributes):
        if tag not in INLINE:
            self.cut()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in CLOSES[tag]:
                    self.close(k)
                    break
                if self.open[k][0] not in INLINE and not (tag == "tr" and self.open[k][0] in ("td", "th")):
                    break
        around = is_around(tag, attributes, self.roots > 0)
        number = len(self.names)
        self.names[number] = tag
        hidden = tag in INLINE and is_concealed(attributes)
        self.open.append((tag, number, around, hidden))
        self.around += around
        self.hidden += hidden
        self.links += tag == "a"
        self.roots += tag in KEPT_ROOTS

    def close(self, at: int) -> None:
        for tag, _, around, hidden in self.open[at:]:
            self.around -= around
            self.hidden -= hidden
            self.links -= tag == "a"
            self.roots -= tag in KEPT_ROOTS
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.cut()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.close(k)
                break
            if tag in INLINE and self.open[k][0] not in INLINE:
                break

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def parse_marked_section(self, i, report=1):
        """Declarations that the parser does not know end at the next bracket, as comments do."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if self.hidden:
            return
        self.pieces.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; beyond the ends there is nothing, and weights are made to sum to one."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma * sigma))
    full = lambda v: np.convolve(v, kernel, mode="full")[reach:reach + len(v)]
    return full(values) / full(np.ones(len(values)))


def main_text(html: str | None) -> tuple[str, int]:
    """The main text and the number of its lines."""
    if not html:
        return "", 0
    parser = Lines()
    parser.feed(html)
    HTMLParser.close(parser)  # hands over what is still buffered
    parser.cut()
    lines = parser.lines
    if not lines:
        return "", 0
    sizes = np.array([len(t) for t, *_ in lines], float)
    around = np.array([a for *_, a in lines])
    linked = np.array([c for _, _, c, _, _ in lines]) > LINK_SHARE * sizes
    ratio = np.where(around | linked, 0.0, sizes / np.maximum(1, [n for _, n, *_ in lines]))
    smoothed = smooth(ratio)
    seeds = (ratio > 0) & (smoothed >= THRESHOLD * smoothed.mean())
    if not seeds.any():
        seeds = ~around
    if not seeds.any():
        return "", 0
    held: dict[int, float] = {}
    for k in np.flatnonzero(seeds):
        for element in lines[k][3]:
            held[element] = held.get(element, 0.0) + sizes[k]
    total = sizes[seeds].sum()
    roots = [e for e, v in held.items() if parser.names[e] in KEPT_ROOTS]
    if roots and max(held[e] for e in roots) >= 0.5 * total:
        # An article within main: the inner one, where it holds most of the outer one's seeds.
        region = max(roots, key=lambda e: (held[e] >= MOST_OF_SEEDS * max(held[r] for r in roots), e))
    else:
        region = max((e for e, v in held.items() if v >= MOST_OF_SEEDS * total), default=-1)
    regions, alone = {region}, set()
    above = next((set(path[:path.index(region) + 1]) for *_, path, _ in lines if region in path), set())
    for k in np.flatnonzero(seeds) if region >= 0 else ():
        if region not in lines[k][3]:
            apart = next((e for e in lines[k][3] if e not in above), None)
            if apart is None:
                alone.add(k)
            else:
                regions.add(apart)
    rooted = [any(parser.names[e] in KEPT_ROOTS for e in path) for *_, path, _ in lines]
    taken = [not out and (k in alone or region < 0 or not regions.isdisjoint(path)) and ((region >= 0 and rooted[k]) or not linked[k])
             for k, (*_, path, out) in enumerate(lines)]
    # A heading outside belongs to the next line that is no heading.
    follows = False
    for k in range(len(lines) - 1, -1, -1):
        if not around[k]:
            if not any(parser.names[e] in HEADINGS for e in lines[k][3]):
                follows = taken[k]
            elif follows and not linked[k]:
                taken[k] = True
    chosen = [t for (t, *_), use in zip(lines, taken) if use]
    return " ".join(chosen), len(chosen)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every page."""
    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [main_text(h) for h in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].to_numpy(), "url": frame["url"], "text": [t for t, _ in found],
                                "n_chars": [len(t) for t, _ in found], "n_blocks": [n for _, n in found]})

    return pages.select("page_id", "url", "html").mapInPandas(extract, "page_id long, url string, text string, n_chars long, n_blocks long")
