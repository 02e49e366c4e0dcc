"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page's events into lines, one for each block of text. A line's ratio is its
characters against the tags met in it; lines of menus, page headers and footers, side bars, adverts, notices, forms and reader
comments, known by element, role or class, have ratio 0. Ratios are smoothed within each region (the innermost container,
or the article), so that they don't leak into neighbours, and split into two clusters by two-means on their
logarithms. A region is content if most of its characters lie in lines of the upper cluster, or if it has most of these; the text is
every line from the first such region to the last that isn't boilerplate, so a table or a short block between them stays.

A class or id name marks boilerplate if all its parts are known (``cookie-notice``, ``site-footer``, not ``ad-hoc`` or ``related-work``);
on paragraphs, headings, items and cells of an article, only if one part is a mark of the stronger kind. ``p``, ``li``, ``dt``, ``dd``, ``tr``, ``td``
and ``th`` that are left open end where HTML ends them. Other elements left open last until an element around them ends.

Defined results: null or empty html, or a page without text, gives an empty text of 0 characters; an empty table an
empty one. Of regions with equally much text, all are content. Pages are read whole; repeated rows each get their row; only the columns named are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside blockquote body details dialog div fieldset footer form header main menu nav ol section table td ul".split())
BOILERPLATE = frozenset("aside button dialog footer form header menu nav search select".split())
HIDDEN = frozenset("canvas datalist iframe noscript object script style svg template textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Parts of class and id names that mark boilerplate always, or only where no part names content.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer login menu nav navbar navigation newsletter pagination promo promoted related replies reply share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
WEAK_MARKS = frozenset("alert alerts banner copyright disclaimer header legal masthead modal notice notices popup search".split())
CONTENT = frozenset("article body content entry main page post story text wrapper".split())
#: Parts that say nothing about what an element holds.
NEUTRAL = frozenset(
    "area bar block blocks bottom box btn button buttons center col column container desktop fixed footer form global group icon icons "
    "inline inner item items js label left link links list main mobile module outer overlay panel policy pop primary right row secondary section "
    "site slot small sticky tags thread title top tower unit up wrap".split()
)
_NOT = frozenset("has no with without".split())
_STRONG_ONLY = MARKS | WEAK_MARKS | CONTENT | NEUTRAL
_WEAK_ONLY = MARKS | WEAK_MARKS | NEUTRAL
#: Elements that hold text rather than parts of a page.
TEXTS = frozenset("blockquote dd dt h1 h2 h3 h4 h5 h6 li p pre td th".split())
_SCOPE = CONTAINERS - {"td"} | {"button", "th"}
_ROW = frozenset({"td", "th", "tr"})
#: Elements that a start tag ends, and where the search for them stops.
ENDED = {tag: (frozenset({"p"}), _SCOPE | {"td"}) for tag in BLOCKS - {"li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "html", "body", "center"}}
ENDED |= {"li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})), "tr": (_ROW, frozenset({"table"}))}
ENDED |= dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd"}), frozenset({"dl"})))
ENDED |= dict.fromkeys(("td", "th"), (frozenset({"td", "th"}), frozenset({"table", "tr"})))
ENDED |= dict.fromkeys(("tbody", "thead", "tfoot"), (_ROW | {"caption", "tbody", "thead", "tfoot"}, frozenset({"table"})))

_PARTS = re.compile(r"[A-Za-z]+")
_SIGMA = 2.0
_REACH = int(3 * _SIGMA)
_KERNEL = np.exp(-0.5 * (np.arange(-_REACH, _REACH + 1) / _SIGMA) ** 2)


def _marked(attributes: list[tuple[str, str | None]], of_article: bool = False) -> bool:
    """Whether attributes say that an element is boilerplate or not shown; ``of_article`` for text of an article."""
    for name, value in attributes:
        value = value or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id"):
            for one in value.split():
                parts = {p.lower() for p in _PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", one))}
                if not parts or not _NOT.isdisjoint(parts):
                    continue
                if not MARKS.isdisjoint(parts) and parts <= _STRONG_ONLY:
                    return True
                if not of_article and not WEAK_MARKS.isdisjoint(parts) and parts <= _WEAK_ONLY:
                    return True
    return False


class Lines(HTMLParser):
    """Collects a page's lines: text, number of tags, region, and whether it is boilerplate."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.stack: list[tuple[str, int, bool, bool]] = []  # element, region, boilerplate, not shown
        self.region, self.regions, self.boiler, self.unseen = 0, 1, False, False
        self.parts: list[str] = []
        self.tags = 0

    def updatepos(self, i, j):
        return j  # nothing asks for line numbers

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.region, self.boiler))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        if tag in ENDED:
            self.end_open(*ENDED[tag])
        if tag in VOID:
            return
        of_article = tag in TEXTS and any(s[0] in ("article", "main") for s in self.stack)
        boiler = tag in BOILERPLATE or (bool(attrs) and tag not in ("html", "body", "article", "main") and _marked(attrs, of_article))
        unseen = tag in HIDDEN
        if tag not in CONTAINERS and not boiler and not unseen:
            return
        if boiler and tag not in BLOCKS:
            self.flush()
        self.stack.append((tag, self.region, self.boiler, self.unseen))
        if tag in CONTAINERS and (tag in ("article", "main") or not any(s[0] in ("article", "main") for s in self.stack[:-1])):
            self.region, self.regions = self.regions, self.regions + 1
        self.boiler, self.unseen = self.boiler or boiler, self.unseen or unseen

    def end_open(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Ends the outermost open element of these names up to the scope."""
        found = None
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in scope:
                break
            if self.stack[k][0] in names:
                found = k
        if found is not None:
            self.flush()
            _, self.region, self.boiler, self.unseen = self.stack[found]
            del self.stack[found:]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.flush()
                _, self.region, self.boiler, self.unseen = self.stack[k]
                del self.stack[k:]
                break

    def handle_data(self, data):
        if not self.unseen:
            self.parts.append(data)


def lines_of(html: str) -> list[tuple[str, int, int, bool]]:
    for text in (html, html.replace("<![", "&lt;![")):  # the parser refuses some broken marked sections
        parser = Lines()
        try:
            parser.feed(text)
            parser.close()
        except AssertionError:
            continue
        parser.flush()
        return parser.lines
    return []


def smoothed(ratios: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Gaussian means of each line's neighbours in its region."""
    out = np.zeros(len(ratios))
    for region in set(regions.tolist()):
        at = np.flatnonzero(regions == region)
        weight = np.convolve(np.ones(len(at)), _KERNEL)[_REACH : _REACH + len(at)]
        out[at] = np.convolve(ratios[at], _KERNEL)[_REACH : _REACH + len(at)] / weight
    return out


def upper_cluster(values: np.ndarray) -> np.ndarray:
    """Two-means in one dimension; with one distinct value, all positive ones are the upper cluster."""
    x = np.log1p(values)
    low, high = float(x.min()), float(x.max())
    if high - low < 1e-9:
        return x > 0
    for _ in range(30):
        upper = x > (low + high) / 2
        n, total = int(upper.sum()), float(x[upper].sum())
        means = (float(x.sum()) - total) / (len(x) - n), total / n
        if abs(means[0] - low) + abs(means[1] - high) < 1e-9:
            break
        low, high = means
    return upper


def main_text(html: str | None) -> str:
    found = lines_of(html or "")
    if not found:
        return ""
    texts, tags, region, boiler = zip(*found, strict=True)
    size, region, boiler = np.array([len(t) for t in texts], dtype=float), np.array(region), np.array(boiler)
    ratio = np.where(boiler, 0.0, size / np.maximum(np.array(tags, dtype=float), 1))
    upper = upper_cluster(smoothed(ratio, region)) & ~boiler
    mass = np.bincount(region, weights=size * upper)
    whole = np.bincount(region, weights=size * ~boiler)
    content = (mass > 0) & ((mass >= 0.5 * whole) | (mass == mass.max()))
    at = np.flatnonzero(content[region] & ~boiler)
    return "\n".join(found[k][0] for k in range(at[0], at[-1] + 1) if not boiler[k]) if len(at) else ""


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text`` and ``n_chars``."""
    source = pages.select(*keep, F.col(html).alias("_html"))
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def apply(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h.as_py()) for h in part.column("_html")]
                columns = [part.column(c) for c in keep]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(apply, schema)
