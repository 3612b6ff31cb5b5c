"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events (tags and decoded text) into lines: what stands between two boundaries of
block elements.  A line's ratio is its characters for each of its tags.  The ratios, smoothed with a Gaussian over
neighbouring lines, fall into two clusters; lines of the upper one that aren't mostly links are the seeds of content.  The
region is the ``article`` or ``main`` element that holds the seeds, else the lowest container that holds nearly all of them.
From an article every line comes, short ones too; from other regions the lines between the first seed and the last.

Left out wherever they stand: elements that are no prose by their name (navigation, page headers and footers, asides, forms,
scripts, styles, embedded objects) or by what their class, id or role says (adverts, notices, sidebars, reader comments and
the like).  A header of an article keeps its headings.

Defined cases: null or empty html, and pages without any such line, give an empty text; text outside all elements counts as a
line of the page; tags and comments that the end of the page cuts off are dropped, elements left open end with their parent;
``br`` is white space, table cells are blocks; white space is what Python's ``str.split`` splits at, no-break spaces
included; repeated pages come as often as they stand there; a null page_id or url stays null; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import picked
from .words import trim

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may hold several blocks; a region is one of them.
CONTAINERS = frozenset("article main section div td th body blockquote center form fieldset aside header footer nav".split())
BLOCKS = CONTAINERS | HEADINGS | frozenset("address caption dd details dialog dl dt figcaption figure hgroup hr html legend li menu ol optgroup option p pre summary table tbody tfoot thead tr ul".split())
#: Elements that hold no prose of an article.
DROPPED = frozenset("aside audio button canvas dialog fieldset footer form head iframe label menu nav noscript object option script select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: What one part of a class or id says about an element.
SAYS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert announcement banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright disclaimer disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination paywall popup promo promotion promoted recommended recommendations "
    "related replies reply respond share sharing shares sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split()
)
#: Parts that turn the others of a name round: an element "with-sidebar" isn't one.
ABOUT = frozenset("with has no without free non is layout".split())
#: A header named after one of these is the head of an article, of which the headings stay.
HEADED = frozenset("article blog content entry post section story".split())
KEPT, SOFT, GONE = 0, 1, 2
#: Drops that an ``article`` or ``main`` inside ends; all others hold for what is in them.
LOOSE = frozenset("form fieldset header nav label menu".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements that end an open one of these when they start.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SIGMA, LINKED, MOST, HALF = 1.0, 0.5, 0.8, 0.3


def _named(tag: str, names: str) -> int:
    """What a class or id makes of an element; headings are what they are."""
    found = KEPT
    for name in names.split() if tag not in HEADINGS else ():
        parts = {p.lower() for p in _PART.findall(name)}
        own = SAYS & parts
        if own and not ABOUT & parts:
            found = max(found, SOFT if own == {"header"} and HEADED & parts else GONE)
    return found


class Lines(HTMLParser):
    """Collects the lines of a page: text, tags, characters in links, container, whether it is dropped, whether a heading."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.tags: list[int] = []
        self.linked: list[int] = []
        self.box: list[int] = []
        self.drop: list[bool] = []
        self.heading: list[bool] = []
        self.item: list[bool] = []
        self.parent, self.name = [-1], ["page"]  # of containers
        self.open: list[tuple[str, int, bool, bool]] = []  # name, container, dropped, in an article's header
        self.count: dict[str, int] = {}
        self.heads = 0  # open headings
        self.held: list[str] = []
        self.held_tags = self.held_links = 0

    def parse_marked_section(self, i, report=1):
        """What looks like a marked section is a comment up to the next ">" in HTML."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def updatepos(self, i, j):
        """Places in lines of the source aren't needed."""
        return j

    def _top(self):
        return self.open[-1] if self.open else ("", 0, False, False)

    def _flush(self) -> None:
        text = " ".join("".join(self.held).split()) if self.held else ""
        if text:
            _, box, drop, soft = self._top()
            head = self.heads > 0
            self.text.append(text)
            self.tags.append(self.held_tags)
            self.linked.append(self.held_links)
            self.box.append(box)
            self.drop.append(drop or (soft and not head))
            self.heading.append(head)
            self.item.append(bool(self.count.get("li")))
        self.held, self.held_tags, self.held_links = [], 0, 0

    def _pop(self, upto: int) -> None:
        while len(self.open) > upto:
            tag = self.open.pop()[0]
            self.count[tag] -= 1
            self.heads -= tag in HEADINGS

    def _find(self, names: tuple[str, ...], through) -> int:
        """Place of the innermost open element of these names, if only elements that ``through`` lets pass stand above it."""
        if len(names) == 1 and self.count.get(names[0]) or len(names) > 1 and any(self.count.get(n) for n in names):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in names:
                    return k
                if not through(self.open[k][0]):
                    break
        return -1

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
            closes = _ENDS.get(tag)
            k = self._find(closes, lambda n: n not in ("ul", "ol", "dl", "table", "select")) if closes else -1
            if k < 0 and self.count.get("p"):
                k = self._find(("p",), lambda n: n not in BLOCKS)
            if k >= 0:
                self._pop(k)
        self.held_tags += 1
        if tag in ("br", "img"):
            self.held.append(" " if tag == "br" else "")
        if tag not in VOID:
            self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _push(self, tag, attrs) -> None:
        _, box, drop, soft = self._top()
        said = dict(attrs) if attrs else {}
        own = tag in DROPPED
        if said and tag not in ("html", "body"):
            role = (said.get("role") or "").lower()
            own = own or role in ROLES or "hidden" in said or said.get("aria-hidden") == "true" or bool(_HIDDEN.search(said.get("style") or ""))
            if tag != "main" and role != "main":
                named = max(_named(tag, said.get(k) or "") for k in ("class", "id"))
                own, soft = own or named == GONE, soft or named == SOFT
        if drop and not own and (tag == "main" or tag == "article" and self._loose()):
            drop = False
        if tag == "header" and not own and not soft:
            soft = any(self.count.get(t) for t in ("article", "main"))
            own = not soft
        if tag in CONTAINERS:
            self.parent.append(box)
            self.name.append("article" if tag in ("article", "main") or said.get("role") in ("main", "article") or "articleBody" in (said.get("itemprop") or "") else tag)
            box = len(self.name) - 1
        self.open.append((tag, box, drop or own, soft))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.heads += tag in HEADINGS

    def _loose(self) -> bool:
        """Whether all that drops the open elements lets an article inside count."""
        before = False
        for name, _, drop, _ in self.open:
            if drop and not before and name not in LOOSE:
                return False
            before = drop
        return True

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.held.append(" ")
            return
        self.held_tags += 1
        if tag in BLOCKS:
            self._flush()
        if self.count.get(tag):
            k = self._find((tag,), (lambda n: True) if tag in CONTAINERS or tag in DROPPED else (lambda n: n not in CONTAINERS))
            if k >= 0:
                self._pop(k)

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.held.append(data)
        if self.count.get("a"):
            self.held_links += len("".join(data.split()))

    def end(self) -> None:
        self.close()
        self._flush()


def whole(page: str) -> str:
    """The page without a comment or tag that its end cuts off."""
    comment = page.find("<!--", max(page.rfind("-->"), 0))
    if comment >= 0 and page.find("</script", comment) < 0:
        page = page[:comment]
    at = page.rfind("<")
    if at > page.rfind(">") and re.match(r"[A-Za-z/!?]", page[at + 1 : at + 2]):
        page = page[:at]
    return page


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Means of neighbours weighted by a Gaussian that reaches three sigma."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    own = slice(reach, reach + len(ratio))
    return np.convolve(ratio, kernel)[own] / np.convolve(np.ones(len(ratio)), kernel)[own]


def threshold(values: np.ndarray) -> float:
    """Where two clusters of values part: two means, begun at the least and the greatest value."""
    low, high = float(values.min()), float(values.max())
    for _ in range(100):
        cut = (low + high) / 2
        upper = values > cut
        if not upper.any() or upper.all():
            return float(values.min())
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def chosen(lines: Lines) -> list[int]:
    """Numbers of the lines of the main text."""
    candidates = [i for i, drop in enumerate(lines.drop) if not drop]
    if not candidates:
        return []
    chars = np.array([len(t) for t in lines.text], np.float64)
    links = np.array(lines.linked) > LINKED * chars
    value = np.log1p(smoothed(chars / np.maximum(lines.tags, 1)))
    cut = threshold(value)
    seeds = [i for i in candidates if value[i] >= cut and not links[i]] or [i for i in candidates if not links[i]] or candidates
    weight = np.zeros(len(lines.name))
    np.add.at(weight, [lines.box[i] for i in seeds], chars[seeds])
    for box in range(len(weight) - 1, 0, -1):
        weight[lines.parent[box]] += weight[box]
    total = weight[0]
    region = max((b for b, name in enumerate(lines.name) if name == "article" and weight[b] >= HALF * total), default=None, key=lambda b: (weight[b], b))
    article = region is not None
    if not article:
        region = 0
        for b in range(1, len(weight)):  # children come behind their parents
            if lines.parent[b] == region and weight[b] >= MOST * total:
                region = b
    inside = [False] * len(weight)
    inside[region] = True
    for b in range(region + 1, len(weight)):
        inside[b] = inside[lines.parent[b]]
    own = [i for i in candidates if inside[lines.box[i]]]
    if not article:
        seed = [i for i in seeds if inside[lines.box[i]]]
        first = own.index(seed[0])
        while first and lines.heading[own[first - 1]]:
            first -= 1
        own = [i for i in own[first:] if i <= seed[-1] and (not links[i] or lines.heading[i])]
        before = [i for i in candidates if i < own[0] and lines.heading[i]]
        own = before[-1:] + own if before and before[-1] == max(i for i in candidates if i < own[0]) else own
    return [i for i in own if not _menu(i, lines, links)]


def _menu(i: int, lines: Lines, links: np.ndarray) -> bool:
    """Whether a line is one of three list items in a row or more that are links only."""

    def only(k: int) -> bool:
        return 0 <= k < len(lines.text) and lines.item[k] and links[k] and lines.box[k] == lines.box[i]

    if not only(i):
        return False
    near = [only(k) for k in range(i - 2, i + 3)]
    return any(all(near[k : k + 3]) for k in range(3))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = Lines()
    lines.feed(whole(page))
    lines.end()
    return "\n".join(lines.text[i] for i in chosen(lines))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
        trim()

    rows = picked(pages, {"page_id": F.col(id_col).cast("long"), "url": F.col(url_col).cast("string"), "html": F.col(html_col).cast("string")})
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


#: The same rows for pages of the tables' shape: one article whose blocks are h1 and p, the four commonest references, no other markup inside.
ORACLE = r"""
WITH a AS (SELECT page_id, url, unnest(regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '</?(p|h1)>')) AS block,
  generate_subscripts(regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '</?(p|h1)>'), 1) AS k FROM pages),
b AS (SELECT page_id, url, k, trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block FROM a)
SELECT page_id, url, coalesce(string_agg(block, chr(10) ORDER BY k) FILTER (block <> ''), '') AS text, coalesce(length(string_agg(block, chr(10) ORDER BY k) FILTER (block <> '')), 0) AS n_chars FROM b GROUP BY page_id, url
"""
