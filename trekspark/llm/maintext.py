"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page's events. Block elements cut the page into lines; a line has its text, the tags
it took, and the elements it stands in. A line's ratio is its letters over its tags; lines inside menus, forms, notices and the
like (by element, role or the words of class and id) count as 0. Ratios are smoothed by a Gaussian over neighbouring lines, and
lines at or above the smoothed ratios' standard deviation are the dense cluster. The content region is the article element that
holds a dense line, if there is one, or the innermost that holds most of the cluster, or else the smallest element with nearly all of it; every
line of the region is the text, however short, but for those of the kinds above.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, only, texts_of

#: Width of the smoothing in lines, and the share of the dense lines' letters that the region holds.
SIGMA, WHOLE = 1.0, 0.9

# Elements of HTML by what they do to a page's lines.
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Not shown or not prose: their text is no part of any line.
SILENT = frozenset("script style template noscript iframe object svg canvas audio video select datalist textarea button title head map".split())
#: Boilerplate by element or role.
APART = frozenset("nav header footer aside form menu dialog search".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar tablist".split())
#: Boilerplate by a word of class or id.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner promo promotion promoted sponsor sponsored sidebar rail widget nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer colophon copyright comment comments commentlist respond disqus reply replies cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended pagination pager toolbar skip disclaimer".split()
)
#: Those of them that name readers' comments, which may be articles themselves.
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus reply replies".split())
#: An open paragraph or item ends where one of these begins.
ENDS_P = BLOCKS - frozenset("body col colgroup head html legend optgroup option summary caption tbody td tfoot th thead title tr dd dt li".split())
ENDS_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
HOME = ("article", "main")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: What may stand in a page's head; anything else, and any text, begins its body.
IN_HEAD = frozenset("head title meta link base style script noscript template".split())


@dataclass
class Element:
    name: str
    parent: int
    block: bool
    apart: bool  # boilerplate by its own name, role or words, or within such
    named: frozenset[str]  # words of class or id that name boilerplate
    silent: bool


@dataclass
class Line:
    element: int
    parts: list[str] = field(default_factory=list)
    tags: int = 0


class Lines(HTMLParser):
    """The lines and elements of a page, in one pass over its events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1, True, False, frozenset(), False)]
        self.open = [0]
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.tags = 0  # since the last text

    def cut(self) -> None:
        self.line = None

    def end_head(self) -> None:
        if self.elements[self.open[-1]].name == "head":
            self.open.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCKS
        if tag not in IN_HEAD:
            self.end_head()
        if block:
            self.cut()
            if tag in ENDS_P:
                self.close_until("p", frozenset({"button", "td", "th", "caption", "object", "table"}))
            if tag in ENDS_SAME:
                for name in ALIKE.get(tag, (tag,)):
                    self.close_until(name, frozenset(ENDS_SAME[tag]))
        self.tags += 1
        if self.line is not None:
            self.line.tags += 1
            self.tags = 0
        if tag in VOID:
            if tag == "br" and self.line is not None:
                self.line.parts.append("\n")
            return
        above = self.elements[self.open[-1]]
        by_words = frozenset()
        if block and tag not in ("html", "body", *HOME):
            by_words = (APART_WORDS & _words(attrs)) - ({"header"} if tag in HEADINGS else set())
        given = dict(attrs)
        apart = tag in APART or (given.get("role") or "").strip().lower() in APART_ROLES or "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "").lower()
        self.elements.append(Element(tag, self.open[-1], block, above.apart or apart, by_words, above.silent or tag in SILENT))
        self.open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if self.line is not None:
            self.line.tags += 1
            self.tags = 0
        self.close_until(tag, frozenset() if tag in BLOCKS else BLOCKS)

    def close_until(self, tag: str, stops: frozenset[str]) -> None:
        """Closes the innermost open element of this name and all in it, unless one of `stops` stands before it."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.elements[self.open[at]].name
            if name == tag:
                del self.open[at:]
                return
            if name in stops:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.end_head()
        at = self.open[-1]
        if self.elements[at].silent:
            return
        if self.line is None:
            if not data.strip():
                return
            while not self.elements[at].block:
                at = self.elements[at].parent
            self.line = Line(at, [], self.tags)
            self.tags = 0
            self.lines.append(self.line)
        self.line.parts.append(data)


def _words(attrs: list[tuple[str, str | None]]) -> set[str]:
    named = " ".join(v for k, v in attrs if k in ("class", "id") and v)
    return set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower())) if named else set()


def ratios(texts: list[str], tags: list[int], apart: list[bool]) -> np.ndarray:
    """Letters over tags of each line, 0 for lines that stand apart."""
    return np.array([0.0 if a else len(t) / max(1, n) for t, n, a in zip(texts, tags, apart)])


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; beyond the page's ends there is nothing."""
    reach = max(1, round(2 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma * sigma))
    return np.convolve(values, kernel / kernel.sum(), "full")[reach : reach + len(values)]


def dense(values: np.ndarray) -> np.ndarray:
    """Lines of the dense cluster: at or above the standard deviation of the smoothed ratios."""
    return (values >= values.std()) & (values > 0) if len(values) else np.zeros(0, bool)


def extract(html: str) -> str:
    """The main text of a page: its blocks joined by newlines, "" if there is none."""
    page = Lines()
    page.feed(html)
    page.close()
    elements = page.elements
    lines = [(line, " ".join("".join(line.parts).split())) for line in page.lines]
    lines = [(line, text) for line, text in lines if text]
    if not lines:
        return ""
    texts = [text for _, text in lines]
    within = [_ancestors(elements, line.element) for line, _ in lines]
    apart = _apart(elements, texts, within)
    found = dense(smoothed(ratios(texts, [line.tags for line, _ in lines], apart)))
    region = _region(elements, texts, within, apart, found)
    return "\n".join(texts[i] for i in region)


def _ancestors(elements: list[Element], at: int) -> list[int]:
    """The element and all around it, the page last."""
    out = [at]
    while elements[at].parent >= 0:
        at = elements[at].parent
        out.append(at)
    return out


def _apart(elements: list[Element], texts: list[str], within: list[list[int]]) -> list[bool]:
    """Whether each line stands apart. An element that class or id names so doesn't, if it holds the longest article, unless as comments, or most of what is left."""
    sizes: dict[int, int] = {}
    total = 0
    for text, around in zip(texts, within):
        if not elements[around[0]].apart:
            total += len(text)
            for e in around:
                sizes[e] = sizes.get(e, 0) + len(text)
    homes = [i for i in sizes if elements[i].name in HOME]
    above = set(_ancestors(elements, max(homes, key=sizes.__getitem__))[1:]) if homes else set()
    named = {i for i, e in enumerate(elements) if e.named and 2 * sizes.get(i, 0) <= total and (i not in above or e.named & COMMENT_WORDS)}
    return [elements[around[0]].apart or any(e in named for e in around) for around in within]


def _region(elements: list[Element], texts: list[str], within: list[list[int]], apart: list[bool], found: np.ndarray) -> list[int]:
    """Places of the lines of the content region."""
    own = [i for i in range(len(texts)) if not apart[i]]
    inside: dict[int, int] = {}
    for i in own:
        if found[i]:
            for e in within[i]:
                inside[e] = inside.get(e, 0) + len(texts[i])
    total = inside.get(0, 0)
    articles = [e for e in inside if elements[e].name == "article"]
    homes = articles if len(articles) == 1 else [e for e, n in inside.items() if elements[e].name in HOME and 2 * n >= total]
    if homes:
        home = max(homes)  # the innermost, as elements are numbered in the order they open
        return [i for i in own if home in within[i]]
    holds = [e for e, n in inside.items() if n >= WHOLE * total]
    if not holds:
        return []
    home = max(holds)
    picked = [i for i in own if home in within[i]]
    if elements[home].name in ("", "html", "body"):  # the article has no element of its own: from its first dense line, or the heading before it, to its last
        hits = [k for k, i in enumerate(picked) if found[i]]
        first, last = hits[0], hits[-1]
        while first and elements[within[picked[first - 1]][0]].name in HEADINGS:
            first -= 1
        picked = picked[first : last + 1]
    return picked


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages (page_id, url, html).

    Null and empty pages, and pages without main text, have the empty text and 0. Broken pages are read as the parser reads
    them, to their end; null ids and urls stay null; repeated rows repeat; an empty table gives no rows; other columns aren't
    read. White space, no-break spaces among it, becomes one space inside a block; a line break inside a block is white space.
    """

    def run(batches):
        for batch in bounded(batches, "html"):
            texts = [extract(html) for html in texts_of(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return only(pages, "page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
