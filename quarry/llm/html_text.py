"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing, clustering.

The standard library's parser streams events into lines (one for each block of text) that know
their text, the tags in them, how much of them are links, and the container they lie in. What an
element's name says is never text (scripts, styles, menus, footers and the like) gives no lines. The logarithm of each line's ratio of text to tags is smoothed by a Gaussian, and a threshold
between two clusters of these values tells lines of content from others.

The region of content is the innermost container that holds nearly all text of content lines (its
article or main element, if it lies in one). All its lines are taken, short ones too, but for inner
containers that the clusters, or the words of their class, id or role, tell to be none of the text:

* forms, and those named after adverts, comments, notices, side bars and so on, unless they hold the page's
  heading or an article, or nothing else on the page is content;
* those with a weaker name (header, share, related ...) and those that are mostly links, if less
  than half of their text is of content lines;
* outside of articles, those without a content line or a heading before the first or after the last
  content line.

If a region has no heading of the first level, the one before it belongs to it.

Defined results: null or empty pages, and pages without text, give an empty text; repeated rows and
null ids are carried along; pages of any length and depth are read whole (time is linear in both);
broken declarations are skipped to their end, as browsers do; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYOUT = frozenset("article body center div html main section table tbody td tr".split())
CONTAINERS = LAYOUT | frozenset("blockquote details dl figure ol ul".split())
BLOCKS = CONTAINERS | frozenset("address aside caption dd dialog dt fieldset figcaption footer form h1 h2 h3 h4 h5 h6 header hr legend li nav option p pre summary tfoot th thead title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("aside button footer head iframe label legend nav noscript object option script select style svg template textarea title menu".split())
FORMS = frozenset("dialog fieldset form".split())
CLOSED_BY_THEIR_LIKE = frozenset("p li option td th tr dt dd".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_WORD = r"(?:^|[-_\s])(?:%s)(?:$|[-_\s])"
STRONG = re.compile(_WORD % r"ads?|advert\w*|breadcrumbs?|captcha|comment(?:s|list)?|consent|cookies?|disclaimer|disqus|footer|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pagination|pop-?up|promo\w*|replies|respond|sidebar|signup|skip|sponsor\w*|subscribe|toolbar|widget", re.I)
WEAK = re.compile(_WORD % r"banners?|header|related|share|sharing|social", re.I)
#: Share of the text of content lines that a region holds.
SHARE = 0.9


def _hint(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """2 or 1 if attributes say, strongly or weakly, that an element is none of the text."""
    found = 0
    for k, v in attrs:
        if k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "role" and (v or "").lower() in ROLES):
            return 2
        if v and k in ("class", "id") and tag not in ("body", "html"):
            if STRONG.search(v):
                return 2
            if WEAK.search(v):
                found = 1
    return found


class Page(HTMLParser):
    """The lines of a page and the containers they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.links: list[int] = []  # characters in links
        self.home: list[int] = []  # container
        self.heads: list[int] = []  # level of the heading, or 0
        self.parent, self.names, self.hints = [-1], ["html"], [0]
        self.stack: list[tuple[str, bool, int]] = []
        self.open: Counter[str] = Counter()
        self.never, self.node = 0, 0
        self.parts: list[str] = []
        self.seen, self.linked = 0, 0

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                level = next((int(t[1]) for t, _, _ in reversed(self.stack[-4:]) if len(t) == 2 and t[0] == "h" and t[1].isdigit()), 0)
                for have, new in ((self.texts, text), (self.tags, self.seen), (self.links, self.linked), (self.home, self.node), (self.heads, level)):
                    have.append(new)
                self.seen = 0
            self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.seen += 1
        if tag in BLOCKS:
            self.cut()
        elif tag == "br" and not self.never:
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in CLOSED_BY_THEIR_LIKE and self.stack and self.stack[-1][0] == tag:
            self.leave()
        never = tag in NEVER or (tag == "header" and not (self.open["article"] or self.open["main"]))
        hint = 2 if tag in FORMS else _hint(tag, attrs) if attrs else 0
        self.stack.append((tag, never, self.node))
        self.open[tag] += 1
        self.never += never
        if not self.never and (hint or tag in CONTAINERS):
            if hint and tag not in BLOCKS:
                self.cut()
            self.parent.append(self.node)
            self.names.append(tag)
            self.hints.append(hint)
            self.node = len(self.names) - 1

    def leave(self) -> None:
        tag, never, before = self.stack.pop()
        if before != self.node and tag not in BLOCKS:
            self.cut()
        self.open[tag] -= 1
        self.never -= never
        self.node = before

    def handle_endtag(self, tag: str) -> None:
        self.seen += 1
        if tag in BLOCKS:
            self.cut()
        if self.open[tag]:
            while self.stack[-1][0] != tag:
                self.leave()
            self.leave()

    def handle_data(self, data: str) -> None:
        if not self.never:
            self.parts.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.rawdata.find(">", i) + 1 or -1


def smooth(x: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """x under a Gaussian of radius 2 sigma, its ends carried on."""
    r = max(1, int(np.ceil(2 * sigma)))
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, r, mode="edge"), w / w.sum(), mode="valid")


def threshold(x: np.ndarray) -> float:
    """Between two clusters of values, by 2-means from the extremes."""
    lo, hi = float(x.min()), float(x.max())
    for _ in range(20):
        cut = (lo + hi) / 2
        below, above = x[x < cut], x[x >= cut]
        new = (float(below.mean()) if len(below) else lo, float(above.mean()) if len(above) else hi)
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2


def content_lines(page: Page, level: float | None = None) -> list[int]:
    """The lines of the main text; level: a threshold other than that between the clusters."""
    size = np.array([len(t) for t in page.texts], dtype=np.float64)
    score = smooth(np.log1p(size / np.maximum(page.tags, 1)))
    upper = score >= (threshold(score) if level is None else level)
    home, parent, hint = np.array(page.home), page.parent, page.hints
    n = len(parent)

    def total(values: np.ndarray) -> list[float]:
        """Sums of the lines in each container; inner ones have larger numbers."""
        sums = np.bincount(home, weights=values, minlength=n).tolist()
        for v in range(n - 1, 0, -1):
            sums[parent[v]] += sums[v]
        return sums

    def below(marks: list[bool]) -> list[bool]:
        """Which containers are marked or lie in a marked one."""
        for v in range(1, n):
            marks[v] = marks[v] or marks[parent[v]]
        return marks

    heads = np.array(page.heads)
    titled = total((heads == 1).astype(float))
    main = [float(name in ("article", "main") and not hint[v]) for v, name in enumerate(page.names)]
    for v in range(n - 1, 0, -1):
        main[parent[v]] += main[v]
    dull = below([hint[v] == 2 and not titled[v] and not main[v] for v in range(n)])
    free = ~np.array(dull)[home]
    if not (upper & free).any():
        if not upper.any():
            return []
        dull, free = [False] * n, np.ones(len(home), dtype=bool)
    weight = total(size * (upper & free))
    kids: dict[int, list[int]] = {}
    for v in range(1, n):
        if page.names[v] in LAYOUT and weight[v] >= SHARE * weight[0]:
            kids.setdefault(parent[v], []).append(v)
    region = 0
    while region in kids:
        region = max(kids[region], key=lambda v: weight[v])
    above = region
    while above > 0 and not (page.names[above] in ("article", "main") and not hint[above]):
        above = parent[above]
    whole = above > 0
    region = above if whole else region

    inside = [v == region for v in range(n)]
    for v in range(1, n):
        inside[v] = inside[v] or inside[parent[v]]
    lines = np.flatnonzero(np.array(inside)[home])
    chars, linked, rich = total(size), total(np.array(page.links, dtype=float)), total(size * upper)
    headed = total((heads > 0).astype(float))
    top = lines[upper[lines] & free[lines]]
    first = [len(home)] * n
    last = [-1] * n
    for i, v in enumerate(page.home):
        first[v], last[v] = min(first[v], i), i
    for v in range(n - 1, 0, -1):
        u = parent[v]
        first[u], last[u] = min(first[u], first[v]), max(last[u], last[v])
    out = [False] * n
    for v in range(region + 1, n):
        if not inside[v] or not chars[v]:
            continue
        poor = 2 * rich[v] < chars[v]
        edge = not whole and page.names[v] in LAYOUT and not rich[v] and not headed[v] and (last[v] < top[0] or first[v] > top[-1])
        out[v] = dull[v] or (poor and (hint[v] == 1 or 2 * linked[v] > chars[v])) or edge
    kept = [i for i, gone in zip(lines.tolist(), np.array(below(out))[home[lines]].tolist(), strict=True) if not gone]
    if kept and not any(page.heads[i] == 1 for i in kept):
        titles = [i for i in np.flatnonzero((heads == 1) & free).tolist() if i < kept[0]]
        kept = titles[-1:] + kept
    return kept


def main_text(html: str | None, level: float | None = None) -> str:
    """The main text of one page, a line for each block."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    page.cut()
    return "\n".join(page.texts[i] for i in content_lines(page, level)) if page.texts else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["__id", "__url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: the id, the url, text, n_chars."""
    a, b = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    out = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html")).mapInArrow(_extract, f"__id {a}, __url {b}, text string, n_chars long")
    return out.withColumnsRenamed({"__id": id_col, "__url": url_col})
