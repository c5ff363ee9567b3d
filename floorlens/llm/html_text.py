"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events; block elements cut the page into lines, each
with its text, its tags and the element that holds it. Per line the text-to-tag ratio is
taken and smoothed with a Gaussian kernel; lines above a threshold (the standard deviation
of the smoothed ratios) form the content cluster. The cluster votes for the region that
holds most of its text: the articles or the main element if more than half of it is there,
else the smallest element with nearly all of it. Every line of that region belongs to the
text, so short paragraphs and headings are kept whole; lines inside menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments never count.

Elements know their parent and lines their element, and open elements are looked up by name,
so the work grows with the page, also with deep or unclosed elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import fresh, text_of

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea svg math "
    "iframe object canvas audio video dialog menu".split()
)
_BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | _SKIPPED
_CLOSES_P = _BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "head", "title"}
#: Elements inside which an open paragraph, or an open list item or cell, is out of reach.
_BARS_P = _BLOCKS - {"p"}
_BARS_ITEM = frozenset(("ul", "ol", "dl", "table", "select"))
_REGIONS = frozenset(("article", "main"))
#: Elements that can hold a page's text; a paragraph or list cannot be its region.
_HOLDERS = frozenset("html body div section td center".split())
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|notices?|gdpr|"
    r"popup|modal|newsletter|subscribe|signup|sidebar|side-bar|rail|menu|nav(?:bar|igation)?|breadcrumbs?|footer|header|"
    r"masthead|comments?|commentlist|respond|replies|reply|disqus|related|recommended|recommendations|share|sharing|"
    r"social|widget|toolbar|pagination|pager|skip-link)(?:$|[\s_-])",
    re.IGNORECASE,
)
_ASIDE_ARTICLE = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|related|recommended|ad|sponsored|promo)(?:$|[\s_-])", re.IGNORECASE)
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())


class PageLines(HTMLParser):
    """Turns parser events into lines: (text, tags, number of the element that holds it).

    `parents` has the parent of each element; element 0 is the page. Elements are numbered as
    they open, so a parent's number is below its children's.
    """

    def __init__(self, by_class: bool = True):
        super().__init__(convert_charrefs=True)
        self.by_class = by_class
        self.lines: list[tuple[str, int, int]] = []
        self.regions: dict[int, str] = {}
        self.holders: set[int] = set()
        self.parents: list[int] = [0]
        self.stack: list[tuple[str, int, bool]] = []
        self.open: dict[str, list[int]] = {}  # depths of the open elements of a name
        self.bars: dict[frozenset, list[int]] = {_BARS_P: [], _BARS_ITEM: []}  # and of those of a set
        self.text: list[str] = []
        self.tags, self.hidden = 0, 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.stack[-1][1] if self.stack else 0))
            self.tags = 0
        self.text = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self.flush()
        if not self.hidden:
            self.tags += 1
        if tag in _CLOSES_P:
            self._close("p", _BARS_P)
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            self._close(tag, _BARS_ITEM)
        if tag == "br":
            self.text.append("\n")
        if tag in _VOID:
            return
        number = len(self.parents)
        self.parents.append(self.stack[-1][1] if self.stack else 0)
        skipped = tag in _SKIPPED or self._marked(tag, attrs)
        if tag in _REGIONS and not self.hidden and not skipped:
            self.regions[number] = tag
        if tag in _HOLDERS:
            self.holders.add(number)
        self.open.setdefault(tag, []).append(len(self.stack))
        for names, depths in self.bars.items():
            if tag in names:
                depths.append(len(self.stack))
        self.stack.append((tag, number, skipped))
        self.hidden += skipped

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in ("svg", "iframe", "canvas"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        if not self.hidden:
            self.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)

    def _marked(self, tag: str, attrs: list) -> bool:
        if not self.by_class or tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if tag == "article":  # an article's class often names its layout
                if name in ("class", "id") and value and _ASIDE_ARTICLE.search(value):
                    return True
                continue
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if value and (name in ("class", "id") and _BOILERPLATE.search(value) or name == "role" and value in _BOILERPLATE_ROLES):
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        return False

    def _close(self, tag: str, bars: frozenset | None = None) -> None:
        """Close the innermost `tag`, and all in it, unless an element of `bars` lies between."""
        depths = self.open.get(tag)
        if not depths or bars and self.bars[bars] and self.bars[bars][-1] > depths[-1]:
            return
        for _ in range(len(self.stack) - depths[-1]):
            name, _, skipped = self.stack.pop()
            self.open[name].pop()
            for names, inner in self.bars.items():
                if name in names:
                    inner.pop()
            self.hidden -= skipped


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; weights are renormalised at the ends."""
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    pad = np.convolve(values, kernel, "full")[radius : radius + len(values)]
    return pad / np.convolve(np.ones(len(values)), kernel, "full")[radius : radius + len(values)]


def content_lines(page: PageLines, sigma: float, share: float) -> list[str]:
    lines = page.lines
    if not lines:
        return []
    size = np.array([len(t) for t, _, _ in lines], float)
    ratio = smoothed(size / np.array([max(n, 1) for _, n, _ in lines]), sigma)
    cluster = ratio >= min(ratio.std(), ratio.max())
    voted = [0.0] * len(page.parents)
    for chosen, weight, (_, _, holder) in zip(cluster, size, lines, strict=True):
        voted[holder] += weight * bool(chosen)
    for n in range(len(voted) - 1, 0, -1):  # an element has the votes of all in it
        voted[page.parents[n]] += voted[n]
    total = voted[0]
    for kind in ("article", "main"):
        inside = within(page, {n for n, k in page.regions.items() if k == kind and voted[n]})
        kept = [i for i, (_, _, holder) in enumerate(lines) if inside[holder]]
        if 2 * size[kept][cluster[kept]].sum() > total:
            return [lines[i][0] for i in kept]
    holders = [n for n in page.holders if voted[n] >= share * total]
    if not holders:
        return [t for t, _, _ in lines]
    inside = within(page, {max(holders)})  # the innermost opened last
    return [t for t, _, holder in lines if inside[holder]]


def within(page: PageLines, chosen: set[int]) -> list[bool]:
    """For each element, whether it or one around it is chosen."""
    inside = [False] * len(page.parents)
    for n, parent in enumerate(page.parents):
        inside[n] = n in chosen or inside[parent]
    return inside


def main_text(html: str, sigma: float = 1.0, share: float = 0.9) -> str:
    text = ""
    for by_class in (True, False):  # a page whose classes rule out everything is read by its tags alone
        page = PageLines(by_class)
        page.feed(html)
        page.close()
        page.flush()
        text = text or "\n".join(content_lines(page, sigma, share))
        if text or not html:
            break
    return text


def extracted(df: DataFrame, html: str = "html", sigma: float = 1.0, share: float = 0.9) -> DataFrame:
    """`df` with `text` (main text, empty if none) and `n_chars` (its code points).

    Columns of these names give way. Null and empty pages have an empty text; broken markup
    is read as the parser reads it; repeated rows and other columns stay; an empty table
    gives an empty result.
    """
    name = fresh(df, "_html")
    df = df.withColumn(name, text_of(html)).drop(*[c for c in ("text", "n_chars") if c != html])

    @F.pandas_udf("string")
    def text_from(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for page in pages:
            yield page.map(lambda h: main_text(h, sigma, share))

    out = df.withColumn("text", text_from(name)).drop(name)
    return out.withColumn("n_chars", F.length("text").cast("long"))
