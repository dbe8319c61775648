"""Main text of web pages by text density.

Parser events of the standard library stream into lines, one for each block of the page; a line has its text, the number of tags in it and
the element that holds it. The text-to-tag ratios of the lines are smoothed by a Gaussian and clustered into two by threshold. Content are the lines above
the threshold, with neighbours that lie above half the way to it. The region is the only article or main element if that holds most of them, else the innermost container that holds
all, with a heading that stands beside it and what lies between. Of the region, all lines count, but for blocks of links at its edges that hold no content line. Lists only veto: lines within menus, headers,
footers, sidebars, notices, adverts, forms or reader comments by tag, role or class are no content and never come back. A class that only has such a word among others (notice-period) vetoes
what is no text by its ratios or mostly links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and class words of HTML.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset("script style noscript template iframe object svg title select textarea button canvas audio video datalist".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl article section main aside div body html nav form blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
BAD_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation navigator menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup share sharing social comment comments disqus respond replies reply related recommended pagination pager search skip login widget toolbar disclaimer paywall".split())
#: Of these, layout words alone may stand on what holds the article; they veto nothing that holds more than half of the dense text.
LAYOUT_WORDS = frozenset("nav navbar navigation navigator menu menubar breadcrumb breadcrumbs sidebar sidebars aside masthead topbar popup modal overlay share sharing social related recommended pagination pager search skip login widget toolbar header".split())
#: Words that may stand beside one of these in a class without making it another thing.
STRUCTURE_WORDS = frozenset("area article author bar block body bottom box btn button buttons col column container content count desktop entry form google group header info inner item items law left link links list main message meta mobile outer page panel post primary right row secondary section site slot text thread title top unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3".split())
#: Class words in front of what an element merely has or lacks.
MERELY = ("has-", "no-", "with-", "without-", "hide-", "not-")
REGIONS = frozenset("article main section div td body html".split())
#: Lines on either side that the Gaussian reaches, and its width.
REACH, SIGMA = 3, 1.0
_WORDS = re.compile(r"[a-z]+")
_SPLIT = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Element:
    """start, end: the lines within. hard: vetoed by tag, role or style here or above; soft: words of class or id that veto this element; weak: such words among others."""

    __slots__ = ("tag", "up", "hard", "soft", "weak", "link", "inside", "start", "end", "at", "vetoed")

    def __init__(self, tag: str, up: _Element | None, hard: bool, soft: frozenset[str], weak: bool, start: int, at: int):
        self.tag, self.up, self.soft, self.weak, self.start, self.end, self.at = tag, up, soft, weak, start, start, at
        self.hard = hard or up is not None and up.hard
        self.link = tag == "a" or up is not None and up.link
        self.inside = tag in ("article", "main") or up is not None and up.inside
        self.vetoed = False


class _Lines(HTMLParser):
    """lines: (text, tags, element, characters of links) in page order; elements: in order of their starts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, _Element, int]] = []
        self.elements: list[_Element] = []
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.tags, self.linked, self.mute = 1, 0, 0
        self.at: _Element | None = None
        self._push("#page", False, frozenset(), False)

    def _push(self, tag: str, hard: bool, soft: frozenset[str], weak: bool) -> None:
        self.at = _Element(tag, self.at, hard, soft, weak, len(self.lines), len(self.elements))
        self.elements.append(self.at)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, e: _Element) -> None:
        while self.at is not e:
            self.at.end = len(self.lines)
            self.open[self.at.tag] -= 1
            self.at = self.at.up

    def flush(self) -> None:
        line = " ".join("".join(self.text).split())
        if line:
            self.lines.append((line, self.tags, self.at, self.linked))
            self.tags = 1
        self.text, self.linked = [], 0

    def end(self) -> None:
        self.close()
        self.flush()
        self._pop_to(self.elements[0])
        self.at.end = len(self.lines)

    def _up_to(self, names: tuple[str, ...], stop: frozenset[str]) -> None:
        if not any(self.open.get(n) for n in names):
            return
        e, found = self.at, None
        while e.up and e.tag not in stop:
            if e.tag in names:
                found = e
                if e.tag == "p":
                    break
            e = e.up
        if found:
            self.flush()
            self._pop_to(found.up)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if self.mute:
            self.mute += tag not in VOID and tag in NOT_TEXT
            if tag == "body":
                self.mute = 0
            elif self.mute:
                return
        if tag in NOT_TEXT:
            self.mute = 1
            return
        if tag in CLOSES_P:
            self._up_to(("p",), SCOPES)
        if tag in SIBLINGS:
            self._up_to(SIBLINGS[tag], frozenset({"table", "ul", "ol", "dl", "select", "body"}))
        if tag in BLOCKS:
            self.flush()
        elif tag in ("br", "img", "wbr"):
            self.text.append(" " if tag == "br" else "")
        if tag not in VOID:
            hard, soft, weak = self._veto(tag, attrs)
            if hard > self.at.hard or soft or weak:
                self.flush()
            self._push(tag, hard, soft, weak)

    def _veto(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, frozenset[str], bool]:
        if tag in BOILERPLATE or tag == "header" and not self.at.inside:
            return True, frozenset(), False
        if tag in ("html", "body", "main", "article"):
            return False, frozenset(), False
        soft: set[str] = set()
        weak = False
        for name, value in attrs:
            if name == "role" and (value or "").lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True, frozenset(), False
            if name == "style" and "display:none" in (value or "").replace(" ", "").lower():
                return True, frozenset(), False
            if name in ("class", "id"):
                for token in (value or "").split():
                    if token.lower().startswith(MERELY):
                        continue
                    words = _WORDS.findall(_SPLIT.sub(" ", token).lower())
                    bad = [w for w in words if w in BAD_WORDS or w == "header" and not self.at.inside]
                    # letters alone and in twos are sizes and prefixes
                    if bad and any(len(w) > 2 and w not in BAD_WORDS and w not in STRUCTURE_WORDS for w in words):
                        weak = True
                    else:
                        soft.update(bad)
        return False, frozenset(soft), weak

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.mute:
            self.mute -= tag in NOT_TEXT
            return
        if not self.open.get(tag):
            if tag == "p":
                self.flush()  # a stray end of a paragraph is an empty one
            return
        e = self.at
        while e.up and e.tag != tag and (tag in BLOCKS or e.tag not in BLOCKS):
            e = e.up
        if e.tag == tag and e.up:
            # what an inline element held keeps its line, but an advert's or a notice's text must not run into its neighbours
            if tag in BLOCKS or e.hard > e.up.hard or e.soft or e.weak:
                self.flush()
            self._pop_to(e.up)

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.text.append(data)
            if self.at.link:
                self.linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA[") and not self.mute:
            self.handle_data(data[6:])


def smoothed(lengths: np.ndarray, tags: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Logarithms of the text-to-tag ratios, each the mean of its neighbours by Gaussian weights. A line that is mostly links is not lifted by its neighbours."""
    ratio = np.log1p(lengths / tags)
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    around = lambda x: np.convolve(x, kernel)[REACH : REACH + len(x)]
    smooth = around(ratio) / around(np.ones(len(ratio)))
    return np.where(2 * linked >= lengths, np.minimum(smooth, ratio), smooth)


def thresholds(smooth: np.ndarray) -> tuple[float, float]:
    """(threshold between the two clusters of ratios: their means' midpoint, iterated; half the way to it from the lower mean). One cluster: its least ratio twice."""
    cut = float(smooth.mean())
    low = least = float(smooth.min())
    for _ in range(32):
        high = smooth >= cut
        if high.all() or not high.any():
            return least, least
        low = float(smooth[~high].mean())
        new = (float(smooth[high].mean()) + low) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut, (cut + low) / 2


def _content(smooth: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Which lines are content: runs of free lines above the lower threshold that reach the upper one somewhere."""
    cut, half = thresholds(smooth)
    near = free & (smooth >= half)
    run = np.cumsum(np.r_[True, near[1:] != near[:-1]])
    return near & np.isin(run, run[near & (smooth >= cut)])


def _veto(page: _Lines, smooth: np.ndarray, lengths: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Which lines are free of vetoes. A layout word does not veto what holds more than half of the dense text, nor the only article or main element; weak words veto nothing that reaches the lower threshold and isn't mostly links."""
    cut, half = thresholds(smooth)
    dense = smooth >= cut
    of = np.array([e.at for _, _, e, _ in page.lines])
    hard = np.array([e.hard for e in page.elements])
    mass = np.r_[0, np.cumsum(np.where(dense & ~hard[of], lengths, 0))]
    mains = [e for e in page.elements if e.tag in ("article", "main") and e.end > e.start and not e.hard]

    def vetoed_without_lifting(e: _Element | None) -> bool:
        while e:
            if e.soft:
                return True
            e = e.up
        return False

    lone = len(mains) == 1 and vetoed_without_lifting(mains[0])
    for e in page.elements:
        veto = bool(e.soft)
        if veto and e.soft <= LAYOUT_WORDS:
            holds = lone and e.start <= mains[0].start and mains[0].end <= e.end
            veto = not holds and 2 * (mass[e.end] - mass[e.start]) <= mass[-1]
        if e.weak and not veto:
            own = slice(e.start, e.end)
            veto = 2 * linked[own].sum() >= lengths[own].sum() or not (smooth[own] >= half).any()
        e.vetoed = e.hard or veto or e.up is not None and e.up.vetoed
    return ~np.array([e.vetoed for e in page.elements])[of]


def _only(page: _Lines, free: np.ndarray, content: np.ndarray, lengths: np.ndarray) -> _Element | None:
    """The only article, else the only main element, if it holds more than half of the content's characters. Articles in an article are parts of it."""
    held = np.r_[0, np.cumsum(np.where(free, 1, 0))]
    mass = np.zeros(len(free) + 1, np.int64)
    mass[content + 1] = lengths[content]
    mass = np.cumsum(mass)
    for tag in ("article", "main"):
        found, end = [], 0
        for e in page.elements:
            if e.tag == tag and e.start >= end and held[e.end] > held[e.start]:
                found.append(e)
                end = e.end
        if len(found) == 1 and 2 * (mass[found[0].end] - mass[found[0].start]) > mass[-1]:
            return found[0]
    return None


def _headed(page: _Lines, region: _Element, free: np.ndarray, lengths: np.ndarray, linked: np.ndarray) -> tuple[_Element, int]:
    """(region, first line) with the heading that stands beside the region: the parent that holds both, below the page's body, or the run of lines from the heading on.

    What comes along is no longer than the region and not mostly links.
    """

    def heads(a: int, b: int) -> list[int]:
        out = []
        for i in range(a, b):
            e = page.lines[i][2]
            while free[i] and e and e.tag not in HEADINGS:
                e = e.up
            if free[i] and e and 2 * linked[i] < lengths[i]:
                out.append(i)
        return out

    def fits(a: int, b: int) -> bool:
        outside = free[a:b].copy()
        outside[max(0, region.start - a) : max(0, region.end - a)] = False
        chars = lengths[a:b][outside].sum()
        return 2 * linked[a:b][outside].sum() < chars <= lengths[region.start : region.end][free[region.start : region.end]].sum()

    e = region.up
    while e and e.tag not in ("body", "html", "#page"):
        if e.start < region.start and heads(e.start, region.start) and fits(e.start, e.end):
            region = e
        e = e.up
    # a page's own heading lies further off than a screen of lines
    near = heads(max(0, region.start - 16), region.start)
    first = near[-1] if near else region.start
    if near and any(page.lines[i][2].tag == "h1" for i in near):
        first = max(i for i in near if page.lines[i][2].tag == "h1")
    return region, first if first < region.start and fits(first, region.end) else region.start


def extract(html: str | None) -> str:
    """Main text: blocks joined by line feeds; empty if there is none. Null counts as empty."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.end()
    if not page.lines:
        return ""
    lengths, tags, linked = np.array([len(x[0]) for x in page.lines]), np.array([x[1] for x in page.lines]), np.array([x[3] for x in page.lines])
    smooth = smoothed(lengths, tags, linked)
    free = _veto(page, smooth, lengths, linked)
    content = np.flatnonzero(_content(smooth, free))
    if not len(content):
        content = np.flatnonzero(free)
        if not len(content):
            return ""
    first, last = int(content[0]), int(content[-1])
    region = _only(page, free, content, lengths)
    if region:
        begin = region.start
    else:
        # elements come in order of their starts, so the last one that holds all content is the innermost
        region = [e for e in page.elements if e.start <= first and last < e.end and (e.tag in REGIONS or not e.up)][-1]
        region, begin = _headed(page, region, free, lengths, linked)
    keep = free.copy()
    keep[:begin] = keep[region.end :] = False
    for e in page.elements[region.at + 1 :]:
        if e.up is region and e.tag in BLOCKS and e.end > e.start and (e.end <= first or e.start > last):
            own = slice(e.start, e.end)
            if 2 * linked[own][free[own]].sum() >= lengths[own][free[own]].sum():
                keep[own] = False
    return "\n".join(page.lines[i][0] for i in np.flatnonzero(keep))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) per input row; null html: empty text, 0. Repeated rows and null keys stay; other columns are ignored."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["k", "u", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(html).alias("h"))
    return rows.mapInArrow(run, f"k {kinds[0]}, u {kinds[1]}, text string, n_chars long").select(F.col("k").alias(key), F.col("u").alias(url), "text", "n_chars")
