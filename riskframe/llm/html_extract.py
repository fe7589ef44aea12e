"""Main text of web pages from the standard library's streaming HTML parser.

1. Parser events give the page as lines: one per block, with its text, the
   number of tags in it, its container and the furniture it lies in. Furniture
   is what element names, roles and the words of class and id tell of menus,
   headers, footers, side bars, notices, adverts, forms and readers' comments.
2. A mark of furniture is judged when the page is read: a form, or a container
   marked by words of layout alone, that holds nearly all prose of the page
   wraps the page and marks nothing. A main, and an article that is no remark, end what
   an element left open around them would mark.
3. Each line gets its text-to-tag ratio (furniture gets none); the ratios are
   smoothed along the page with a Gaussian, and a two-means threshold on their
   logarithms clusters the lines into content and the rest.
4. The content lines select a region: from the deepest container that holds
   nearly all of their text up to the outermost article or main around it, or
   without one up to the outermost container that adds more than furniture and
   lists of links. Its lines, short ones included and furniture left out, are
   the main text.

Containers and marks are numbered and know their parents, and open elements
are found by name, so a page takes time in proportion to its length however
deep or unclosed its elements are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and class words (fixed values, from the HTML standard and common page furniture)
SKIPPED = frozenset("script style template noscript head title svg math iframe object canvas audio video select textarea "
                    "datalist".split())
FURNITURE = frozenset("nav footer aside form dialog menu button fieldset header".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
CONTAINERS = frozenset("html body main article section div td table center".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation "
                  "menu menubar breadcrumb breadcrumbs sidebar aside rail footer masthead toolbar pagination pager cookie "
                  "cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe signup login search "
                  "share sharing social related recommended widget".split())
REMARKS = frozenset("comment comments respond disqus reply replies discussion remark remarks".split())
# never the wrapper of a page, however much prose they hold
_SURE = REMARKS | frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
                            "consent gdpr notice notices newsletter subscribe signup login".split())
# words that may stand beside those in a name that is furniture as a whole ("site-nav", "related-posts", "comment-list-2")
BESIDE = frozenset("site main page top bottom left right primary secondary tertiary global local box list lists item items section "
                   "area wrapper wrap container block bar bars link links inner outer post posts article articles entry entries "
                   "blog news story stories mobile desktop header head form button buttons icon icons group panel pane column "
                   "col row grid slot unit text message content body title heading count thread threads author user node tree "
                   "the a an my our and more you may also like by for of policy center centre sticky fixed floating large small "
                   "horizontal vertical responsive google leaderboard skyscraper media tags toggle dropdown sub level mega "
                   "index home outer bx cont id view module component region footer".split())
_NEGATED = frozenset("no not non has have with without hide is show hidden remove".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACES = re.compile(r"\s+")
_CLOSES = {"p": ("p",), "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"),
           "dd": ("dt", "dd"), "option": ("option",)}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                    "main menu nav ol p pre section table ul".split())
SIGMA = 1.5
COVER = 0.9


HEAD_ONLY = frozenset("title meta link base script style noscript template".split())
_RESET = frozenset("nav header form button menu fieldset dialog".split())  # what an article or main inside cannot belong to
WRAPS = 0.9       # share of the page's prose in a container that wraps the page
_PROSE = 40       # characters of a line of prose, at least


@dataclass
class Line:
    text: str
    tags: int
    node: int         # container it lies in; 0 is the page
    mark: int         # innermost mark of furniture; -1: none
    linked: int = 0   # characters inside links

    @property
    def prose(self) -> bool:
        return len(self.text) >= _PROSE and 2 * self.linked < len(self.text)


@dataclass
class Mark:
    """A container that may be furniture: sure, unless only a form or its words say so."""
    parent: int
    sure: bool
    remark: bool


@dataclass
class Page:
    lines: list[Line]
    parent: list[int]          # of each container; containers are numbered as they open
    articles: frozenset[int]
    furniture: list[bool]      # of each mark, with the marks around it


def furniture_words(value: str) -> frozenset[str]:
    """The furniture words of a class or id whose names are nothing but furniture; "no-sidebar" and "related-work" are not."""
    found: set[str] = set()
    for name in value.split():
        parts = [w.lower() for w in _PARTS.findall(name)]
        hits = [w for w in parts if w in WORDS or w in REMARKS]
        if hits and parts[0] not in _NEGATED and all(w in WORDS or w in REMARKS or w in BESIDE for w in parts):
            found.update(hits)
    return frozenset(found)


class _Parser(HTMLParser):
    """Collects the lines of a page from parser events. Elements left open are closed by what follows, as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, int]] = []               # name, skipped, mark
        self.at: dict[str, list[int]] = defaultdict(list)         # name -> its places in open
        self.blocks: list[int] = []                               # places of all but inline elements
        self.holders: list[int] = []                              # places of containers
        self.parent = [0]
        self.node = 0
        self.articles: set[int] = set()
        self.marks: list[Mark] = []
        self.linked = 0
        self.text: list[str] = []
        self.tags = 0

    def _state(self) -> tuple[bool, int]:
        return self.open[-1][1:] if self.open else (False, -1)

    def _last(self, *names: str) -> int:
        """Place of the innermost open element of these names; -1: none."""
        return max((self.at[n][-1] for n in names if self.at[n]), default=-1)

    def flush(self) -> None:
        text = _SPACES.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append(Line(text, self.tags, self.node, self._state()[1], self.linked))
            self.tags = 0
        self.text.clear()
        self.linked = 0

    def _mark(self, tag: str, attrs: list, around: int) -> int:
        """The mark of an element's lines: a new one, or the one around it."""
        remark = any(m.remark for m in self.marks[around:around + 1]) if around >= 0 else False
        words = frozenset().union(*(furniture_words(v) for n, v in attrs if n in ("class", "id") and v)) if attrs else frozenset()
        new = None
        if tag in ("html", "body"):
            pass
        elif tag in ("main", "article"):
            if words & REMARKS or tag == "article" and words & WORDS:
                new = Mark(around, True, bool(words & REMARKS))
            elif around >= 0 and not remark and (tag == "main" or self._reset(around)):
                return -1
        elif tag == "header" and self.at["article"]:
            pass  # it holds the title
        elif tag in FURNITURE:
            new = Mark(around, tag != "form", False)
        else:
            for name, value in attrs:
                value = (value or "").strip().lower()
                if (name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES
                        or name == "style" and "display:none" in value.replace(" ", "")):
                    new = Mark(around, True, False)
            if new is None and words:
                new = Mark(around, bool(words & _SURE), bool(words & REMARKS))
        if new is None:
            return around
        new.remark |= remark
        self.marks.append(new)
        return len(self.marks) - 1

    def _reset(self, mark: int) -> bool:
        """Whether all that marks an article are elements that end where it begins."""
        return all(name in _RESET or name in ("article", "main") for name, _, m in self._marking(mark))

    def _marking(self, mark: int) -> Iterator[tuple[str, bool, int]]:
        """Open elements that brought the marks around, innermost first."""
        place = len(self.open) - 1
        while mark >= 0 and place >= 0:
            while place > 0 and self.open[place - 1][2] == mark:
                place -= 1
            yield self.open[place]
            mark, place = self.marks[mark].parent, place - 1

    def _close(self, at: int) -> None:
        """Close the open elements from place `at` on."""
        self.flush()
        for name, _, _ in reversed(self.open[at:]):
            if name in CONTAINERS:
                self.node = self.parent[self.node]
                self.holders.pop()
            if name not in INLINE:
                self.blocks.pop()
            self.at[name].pop()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag not in HEAD_ONLY and tag not in ("head", "html") and self.at["head"]:
            self._close(self.at["head"][0])
        if tag == "br" or tag == "hr" or tag not in INLINE and tag not in VOID:
            self.flush()
        if tag in VOID:
            return
        if tag in _ENDS_P and (p := self._last("p")) > (self.holders[-1] if self.holders else -1):
            self._close(p)
        if tag in _CLOSES and tag != "p" and (near := self._last(*_CLOSES[tag])) > self._last("ul", "ol", "dl", "table", "select"):
            self._close(near)
        skipped, mark = self._state()
        if attrs or tag in FURNITURE or tag in ("main", "article"):
            mark = self._mark(tag, attrs, mark)
        if tag in CONTAINERS:
            self.parent.append(self.node)
            self.node = len(self.parent) - 1
            self.holders.append(len(self.open))
            if tag in ("article", "main"):
                self.articles.add(self.node)
        if tag not in INLINE:
            self.blocks.append(len(self.open))
        self.at[tag].append(len(self.open))
        self.open.append((tag, skipped or tag in SKIPPED, mark))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        at = self._last(tag)
        if at < 0:
            return
        if tag not in INLINE:
            self._close(at)
        elif at == len(self.open) - 1:
            self.open.pop()
            self.at[tag].pop()

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.text.append(data)
            if self.at["a"]:
                self.linked += len(data.strip())


def _summed(own: list[int], parent: list[int], first: int) -> list[int]:
    """Own values and those of everything inside; a parent has a smaller number, below `first` it has none."""
    out = list(own)
    for k in range(len(out) - 1, first - 1, -1):
        if parent[k] >= 0 and k != parent[k]:
            out[parent[k]] += out[k]
    return out


def read_page(html: str) -> Page:
    """Lines, containers and judged marks of a page."""
    parser = _Parser()
    parser.feed(html)
    parser.close()
    parser.flush()
    marks, lines = parser.marks, parser.lines
    prose, bare = [0] * len(marks), 0
    for line in lines:
        if line.prose:
            if line.mark >= 0:
                prose[line.mark] += len(line.text)
            else:
                bare += len(line.text)
    prose = _summed(prose, [m.parent for m in marks], 0)
    # prose inside marks that are sure is furniture whatever wraps it
    sure = [False] * len(marks)
    hidden = [0] * len(marks)  # prose inside sure marks inside this one
    for k, m in enumerate(marks):
        sure[k] = m.sure or m.parent >= 0 and sure[m.parent]
    for k in range(len(marks) - 1, -1, -1):
        up = marks[k].parent
        if up >= 0:
            hidden[up] += prose[k] if marks[k].sure else hidden[k]
    page = bare + sum(prose[k] - (prose[k] if m.sure else hidden[k]) for k, m in enumerate(marks) if m.parent < 0)
    furniture = [False] * len(marks)
    for k, m in enumerate(marks):
        own = prose[k] - hidden[k]
        wraps = not m.sure and own > 0 and own >= WRAPS * page
        furniture[k] = not wraps or m.parent >= 0 and furniture[m.parent]
    return Page(lines, parser.parent, frozenset(parser.articles), furniture)


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; the page's ends count as empty lines."""
    half = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, half), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Two-means threshold on the logarithms: halfway between the low and the high cluster."""
    x = np.log1p(values)
    low, high = x.min(), x.max()
    for _ in range(50):
        cut = (low + high) / 2
        above = x > cut
        if not above.any() or above.all():
            break
        new = x[~above].mean(), x[above].mean()
        if np.allclose(new, (low, high)):
            break
        low, high = new
    return float(np.expm1((low + high) / 2))


def select(page: Page) -> list[Line]:
    """The lines of the content region."""
    lines, parent = page.lines, page.parent
    shown = np.array([line.mark < 0 or not page.furniture[line.mark] for line in lines], bool)
    if not shown.any():
        return []
    ratio = np.array([len(line.text) / max(1, line.tags) if s else 0.0 for line, s in zip(lines, shown)])
    level = smoothed(ratio)
    content = shown & (level >= threshold(level)) if len(lines) > 1 else shown
    if not content.any():
        content = shown
    weight, prose, depth = [0] * len(parent), [0] * len(parent), [0] * len(parent)
    for line, s, c in zip(lines, shown, content):
        weight[line.node] += len(line.text) if c else 0
        prose[line.node] += bool(s and 2 * line.linked < len(line.text))
    weight, prose = _summed(weight, parent, 1), _summed(prose, parent, 1)
    for k in range(1, len(parent)):
        depth[k] = depth[parent[k]] + 1
    region = max((k for k in range(len(parent)) if weight[k] >= COVER * weight[0]), key=lambda k: depth[k])
    chain = [region]
    while chain[-1]:
        chain.append(parent[chain[-1]])
    around = [k for k in chain if k in page.articles]
    if around:
        region = around[-1]
    else:
        gains = [k for k, inner in zip(chain[1:], chain) if prose[k] > prose[inner]]
        region = gains[-1] if gains else region
    inside = [k == region for k in range(len(parent))]
    for k in range(1, len(parent)):
        inside[k] = inside[k] or inside[parent[k]]
    return [line for line, s in zip(lines, shown) if s and inside[line.node]]


def main_text(html: str | None) -> str:
    """Main text of a page, blocks joined by one space; empty for null, empty or textless pages."""
    return " ".join(line.text for line in select(read_page(html))) if html else ""


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per input row, from the whole html.

    Null and empty pages, and pages without text outside their furniture, give
    an empty text. Repeated rows and null ids or urls are kept as they are.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
