"""Main text of web pages: streaming parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

html.parser turns a page into lines: a line is the text between two block boundaries, with the number of tags in it and how
much of its text is in links. Elements that can't hold content (navigation, headers, footers, sidebars, forms, scripts, adverts,
notices, comments) are passed over: by tag, by role, or by a class or id all of whose words name such parts or layout, so `ad-box` and `cookie-notice` go and `social-policy` and `share-prices` stay.
Of a header inside an article its headings stay. The logarithm of the text-to-tag ratio is
smoothed by a Gaussian and split into two clusters by a threshold that is refined as in 2-means. The lines above it vote for the
deepest element that holds nine tenths of their text. The content region is the article around it or the one inside it that holds most of that text, else the main element; all its lines
are kept in page order, and of a main element around the article its headings and paragraphs. Without either, the region grows to
the enclosing sections and divisions as long as they add no lines of links below the threshold, and of it and of a whole page groups of such lines are left out; a paragraph or heading is no such line.

Time is linear in the page: elements know their parent, and an element's lines are those of a range of elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harvestry.llm.common import map_batches

CHUNK = 1 << 16
SIGMA = 1.0
SHARE = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"br"}
SKIPPED = frozenset("aside button canvas datalist dialog embed footer form head header iframe map math menu nav noframes noscript object script select style svg template textarea title".split())
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert comment comments "
    "commentlist disqus reply replies respond sidebar aside rail menu navbar nav navigation navi breadcrumb breadcrumbs pagination pager footer foot header masthead topbar share sharing social "
    "related recommended recommendations popup modal overlay newsletter subscribe subscription signup login widget widgets toolbar skip hidden".split()
)
#: Words of layout that a telling name may hold beside those.
NEUTRAL_WORDS = frozenset(
    "area articles bar block body bottom box btn button buttons center col column container content count desktop div element end fixed form frame global group head icons id in inner item items js large left level line link links "
    "list main mobile module outer page panel post posts primary print right row section side site slot small space sticky text thread title to top unit user users video wide wrap wrapper zone".split()
)
ARTICLE_WORDS = frozenset("ad advert comment comments related reply".split())
LAYOUT_WORDS = frozenset("has with no without layout wrapper grid".split())
OWN_WORDS = frozenset("article entry post story content".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
REGIONS = frozenset("article main section div td body html".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def names_skipped(value: str, words: frozenset[str]) -> bool:
    """Whether a class or id names one of the words, and beside it nothing but such words, layout and numbers; names like has-sidebar speak of the page, and names like post-header of its title."""
    for name in value.split():
        parts = [p for p in _SPLIT.split(_CAMEL.sub("-", name).lower()) if p]
        if words.isdisjoint(parts) or not LAYOUT_WORDS.isdisjoint(parts) or (parts[-1] == "header" and not OWN_WORDS.isdisjoint(parts)):
            continue
        if all(p in SKIPPED_WORDS or p in NEUTRAL_WORDS or p.isdigit() for p in parts):
            return True
    return False


def is_skipped(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in SKIPPED:
        return True
    if tag in ("html", "body"):
        return False
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id"):
            if names_skipped(value, ARTICLE_WORDS if tag in ("article", "main") else SKIPPED_WORDS):
                return True
        elif name == "role" and value.strip().lower() in SKIPPED_ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True
    return False


@dataclass
class Line:
    """Text, tags in it, its linked characters, the innermost region element, and the innermost block."""

    text: str
    tags: int
    linked: int
    region: int
    block: str


@dataclass
class Open:
    """An open element: whether it is passed over, whether it is an article's header, its region number (-1: none), and how many elements of running text of each name are open in it (of a block)."""

    tag: str
    skipped: bool
    header: bool
    region: int
    running: dict[str, int] | None


class Lines(HTMLParser):
    """Collects the lines of a page, and of each region element its tag, its parent (-1: none) and the last region inside it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.names: list[str] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.open: list[Open] = []
        self.blocks: list[int] = []  # places of the open blocks
        self.running: dict[str, int] = {}  # elements of running text that are open outside any block
        self.count: dict[str, int] = {}  # open elements by name
        self.region = -1
        self.skipping = self.headers = self.links = self.tags = self.linked = 0
        self.parts: list[str] = []

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append(Line(text, self.tags, min(self.linked, len(text)), self.region, self.open[self.blocks[-1]].tag if self.blocks else ""))
        self.parts, self.tags, self.linked = [], 0, 0

    def drop(self, k: int) -> None:
        """Close the open elements from place k on."""
        while len(self.open) > k:
            e = self.open.pop()
            self.count[e.tag] -= 1
            self.skipping -= e.skipped
            self.headers -= e.header
            self.links -= e.tag == "a"
            if e.running is not None:
                self.blocks.pop()
            else:
                self.within()[e.tag] -= 1
            if e.region >= 0:
                self.last[e.region] = len(self.names) - 1
                self.region = self.parent[e.region]

    def within(self) -> dict[str, int]:
        return self.open[self.blocks[-1]].running if self.blocks else self.running

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
            if tag in CLOSES_P and self.blocks and self.open[self.blocks[-1]].tag == "p":
                self.drop(self.blocks[-1])
        self.tags += 1
        if tag in VOID:
            return
        header = tag == "header" and self.count.get("article", 0) > 0
        skipped = not header and is_skipped(tag, attrs)
        region = -1
        if tag in REGIONS:
            region = len(self.names)
            self.names.append(tag)
            self.parent.append(self.region)
            self.last.append(region)
            self.region = region
        if not block:
            own = self.within()
            own[tag] = own.get(tag, 0) + 1
        else:
            self.blocks.append(len(self.open))
        self.open.append(Open(tag, skipped, header, region, {} if block else None))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.skipping += skipped
        self.headers += header
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
        self.tags += 1
        # an end tag of running text doesn't close blocks
        if not (self.count.get(tag, 0) if block else self.within().get(tag, 0)):
            return
        k = len(self.open) - 1
        while self.open[k].tag != tag:
            k -= 1
        self.drop(k)

    def handle_data(self, data: str) -> None:
        if not self.skipping and not (self.headers and not any(self.count.get(h) for h in HEADINGS)):
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def end(self) -> None:
        self.close()
        self.flush()
        self.drop(0)


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with edges repeated."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(x: np.ndarray) -> float:
    """The midpoint between the means of the two clusters that it splits x into; the least value if all are alike."""
    cut = float(x.mean())
    for _ in range(50):
        low, high = x[x < cut], x[x >= cut]
        if not len(low) or not len(high):
            return float(x.min())
        new = float(low.mean() + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def content(page: Lines) -> list[str]:
    """Texts of the lines of the content region, in page order."""
    lines, names, parent = page.lines, page.names, page.parent
    if not lines:
        return []
    chars = np.array([len(x.text) for x in lines], dtype=float)
    ratio = np.log1p(chars / np.maximum([x.tags for x in lines], 1))
    level = smooth(ratio)
    cut = threshold(level)
    linked = np.array([x.linked for x in lines], dtype=float) / chars > 0.5
    paragraph = np.array([x.block in PARAGRAPHS for x in lines])
    region = np.array([x.region for x in lines])
    voting = (level >= cut) & ~linked
    votes = np.bincount(region[voting & (region >= 0)], weights=chars[voting & (region >= 0)], minlength=len(names)).tolist()
    for r in range(len(names) - 1, 0, -1):  # a region's number is over its parent's
        if parent[r] >= 0:
            votes[parent[r]] += votes[r]
    total = float(chars[voting].sum())
    inside = next((r for r in range(len(names) - 1, -1, -1) if votes[r] >= SHARE * total > 0), None)  # of nested elements the deepest has the highest number
    menu = linked & ~(ratio >= cut) & ~paragraph
    if inside is None:
        return [x.text for x, away in zip(lines, menu, strict=True) if not away]
    holds = lambda r: (region >= r) & (region <= page.last[r])
    path, r = [], inside
    while r >= 0:
        path.append(r)
        r = parent[r]
    most = next((r for r in range(inside, page.last[inside] + 1) if names[r] == "article" and votes[r] > total / 2), None)  # one of several would not have it
    article = next((r for r in path if names[r] == "article"), most)
    article = next((r for r in path if names[r] == "main"), None) if article is None else article
    if article is not None:
        around = next((r for r in reversed(path) if names[r] == "main"), article)
        keep = holds(article) | holds(around) & paragraph
    else:
        keep = holds(inside)
        for r in path[1:]:
            if names[r] in ("body", "html") or (holds(r) & ~keep & menu).any():
                break
            keep = holds(r)
        beside = np.zeros(len(lines), dtype=bool)
        beside[1:] |= menu[:-1]
        beside[:-1] |= menu[1:]
        keep &= ~(menu & (beside | (names[inside] in ("body", "html"))))
    return [x.text for x, kept in zip(lines, keep, strict=True) if kept]


def extract(html: str | None) -> str:
    """Main text of a page; empty for null, empty or contentless pages. The page is fed in pieces of 64 K characters."""
    if not html:
        return ""
    parser = Lines()
    for at in range(0, len(html), CHUNK):
        parser.feed(html[at : at + CHUNK])
    parser.end()
    return " ".join(content(parser))


def extract_text(df: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """df with a string column `out`, never null: empty for null, empty and contentless pages.

    Other columns pass through; an existing column `out` is replaced. Each row is read by itself, so rows that repeat have equal texts; pages are read whole, in linear time, and an empty table gives an empty one.
    """
    base = df.drop(out)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"`{out}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(batch.schema.get_field_index(html))
            texts = [extract(p.as_py()) for p in pages]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=[*batch.schema.names, out])

    return map_batches(base, run, schema)


def page_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), for each row of pages."""
    from pyspark.sql import functions as F

    return extract_text(pages.select("page_id", "url", "html"), out="text").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
