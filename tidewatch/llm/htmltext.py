"""Main text of web pages: structure first, then nearest-URL page differencing.

A page is read into text blocks in page order. A block inside an element that
holds menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or comments is dropped. The tag tells it, or a whole class, id or role
name whose noun is furniture ("site-nav", "related-posts"; not "related-work",
"has-comments" or "entry-header"); inside an article, ids are anchors. A block
inside an article or main element is kept, but an article that is itself a
reader's comment is not. Paragraphs, list items and table cells without an end
tag end where HTML ends them; inline tags never cut a block. What the structure leaves open is decided
by differencing: pages of a host are put in order of their URL path, each is
paired with the neighbour that shares the longer path prefix, the open blocks
of both are aligned by their longest common subsequence, and aligned (shared)
blocks are deleted as page furniture.

All pages are ranged by host and path into contiguous parts, so a host with a
third of all pages is many parts; neighbours are found inside a part, and the
first and last page of each part are carried to the parts beside it. So the
partner is the nearest path of the host at every size and across folders. Only
keys are ordered, and only open blocks are moved between pages, never kept text.

Defined results: a null or empty page has an empty text; a page without a
partner keeps its open blocks; a null URL pairs with nothing; pages of a host
whose open blocks are equal (repeated rows, copies under other URLs) count as
one page and are extracted alike. Further columns are not read.
"""

from __future__ import annotations

import html as _html
import itertools
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from tidewatch.llm.common import ship
from tidewatch.operators.joins import materialise

ship(__name__)

SALTS = 16  # parts of the rows that share one page's open blocks

# Quotes hide a ">" only in attribute values. No repeat gives back what it took, so a token costs its own length.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
                    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)>|[^<]++|<", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?")
_NAME_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
# Names of page furniture, words that say which part or form of it, words that make a name a
# state of something else ("has-comments"), and what has a header of its own ("entry-header").
_FURNITURE = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|popups?|modal|menus?|nav\w*|breadcrumbs?|sidebars?|aside|"
    r"footer|header|masthead|comments?|disqus|respond|related|share|sharing|social|subscribe|newsletter|search|login|signin|signup|widgets?|toolbar|"
    r"skip|pagination|pager|complementary|contentinfo|copyright")
_READERS = re.compile(r"comments?|disqus|respond")
_PARTS = set("area articles bar block body bottom box btn button buttons col column container content desktop field form group icon icons inner "
             "input item items label left link links list main media mobile outer panel posts primary region right row secondary section "
             "slot stories text thread title to top unit wrap wrapper zone".split())
_STATES = set("has hide is no non not show with without".split())
_HEADED = set("article content entry page post story".split())
# Elements by what they hold.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "object"}
_RAW_END = {tag: re.compile(rf"</{tag}(?![^\s/>])[^>]*(?:>|\Z)", re.I) for tag in _RAW}
_DROP = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head"}
_MAIN = {"article", "main"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
           "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What ends an open paragraph, the lists and tables whose items end each other, and the items that a new one ends.
_ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "header",
           "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", *_HEADING}
_HOLDERS = {"ul", "ol", "menu", "dl", "table"}
_ENDS_ITEM = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
              "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th"), "tfoot": ("tr", "td", "th")}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def _furniture(name: str) -> str:
    """The furniture that a whole class, id or role name stands for, or an empty string."""
    parts = [x.lower() for x in _NAME_PARTS.split(name.partition("--")[0].strip("-_"))]
    if parts[0] in _STATES:
        return ""
    while len(parts) > 1 and (parts[-1] in _PARTS or parts[-1].isdigit()):
        parts.pop()
    if not _FURNITURE.fullmatch(parts[-1]) or parts[-1] == "header" and len(parts) > 1 and parts[-2] in _HEADED:
        return ""
    return parts[-1]


def _drops(tag: str, attributes: dict[str, str], in_main: bool, in_article: bool) -> bool:
    """Is the element page furniture, by its tag or by a name?

    Inside an article a header is the article's own, and an id is an anchor
    unless it names the readers' comments. Headings have no names that count.
    """
    if tag in _HEADING or tag in ("body", "html", "main"):
        return False
    named = {_furniture(x) for a in ("class", "role") for x in attributes.get(a, "").split()}
    ids = {_furniture(x) for x in attributes.get("id", "").split()}
    readers = any(_READERS.fullmatch(x) for x in named | ids)
    if tag == "article":
        return readers or any(x.startswith(("ad", "sponsor", "promo")) for x in named)
    if tag in _DROP and not (tag == "header" and in_main):
        return True
    if in_article:
        return readers or bool(named - {"", "header"})
    if tag == "header" and in_main:
        named -= {"header"}
    return bool((named | ids) - {""})


class _Open:
    """The open elements of a page, and how many of them are furniture, main elements and articles."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, int, int]] = []
        self.furniture = self.main = self.article = 0
        self.places: dict[str, list[int]] = {}  # where each tag is open
        self.items: list[tuple[int, dict[str, int]]] = [(-1, {})]  # lists and tables, with their open items

    def push(self, tag: str, drops: bool, keeps: bool) -> None:
        if tag in _HOLDERS:
            self.items.append((len(self.stack), {}))
        elif tag in _ENDS_ITEM:
            self.items[-1][1][tag] = len(self.stack)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, drops, keeps, tag == "article"))
        self.furniture += drops
        self.main += keeps
        self.article += tag == "article"

    def cut(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        while len(self.stack) > depth:
            tag, drops, keeps, article = self.stack.pop()
            self.places[tag].pop()
            self.furniture -= drops
            self.main -= keeps
            self.article -= article
            if self.items[-1][0] == len(self.stack):
                self.items.pop()
            elif self.items[-1][1].get(tag) == len(self.stack):
                del self.items[-1][1][tag]

    def end(self, tag: str) -> None:
        """An end tag closes the nearest element of its name, if there is one."""
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def end_before(self, tag: str) -> None:
        """Elements that end by themselves where ``tag`` begins."""
        if tag in _ENDS_P and self.places.get("p"):
            self.cut(self.places["p"][-1])
        if tag in _ENDS_ITEM:
            here = self.items[-1][1]
            self.cut(min((here[x] for x in _ENDS_ITEM[tag] if x in here), default=len(self.stack)))


def _blocks(page: str) -> list[tuple[bool, str]]:
    """(kept for sure, text) of the blocks that the structure does not drop, in time linear in the page."""
    out: list[tuple[bool, str]] = []
    words: list[str] = []
    opened = _Open()

    def close() -> None:
        text = " ".join(_html.unescape("".join(words)).split())
        words.clear()
        if text:
            out.append((opened.main > 0, text))

    at = 0  # up to here the page has been read; what a raw element holds is skipped unread
    last = page.rfind(">") + 1  # no tag ends after it, so none is sought there
    while at < last:
        token = _TOKEN.match(page, at, last)
        t, at = token[0], token.end()
        if t[0] != "<" or t == "<":
            if not opened.furniture:
                words.append(t)
            continue
        if not token["tag"]:
            if t.startswith(("<!--", "<![CDATA[")) and not t.endswith(("-->", "]]>")):
                at = len(page)  # never closed
            continue
        tag, rest = token["tag"].lower(), token["rest"]
        closed = rest.rstrip().endswith("/")
        if tag in _RAW and not token["end"]:
            # A script may hold "<", quotes and what looks like tags: only its own end tag counts.
            if not closed:
                over = _RAW_END[tag].search(page, at)
                at = over.end() if over else len(page)
            continue
        if tag not in _INLINE:
            close()
        if token["end"]:
            opened.end(tag)
            continue
        opened.end_before(tag)
        if tag in _VOID or closed:
            continue
        attributes: dict[str, str] = {}
        for name, value in _ATTR.findall(rest):
            attributes.setdefault(name.lower(), value.strip("\"'"))
        drops = _drops(tag, attributes, opened.main > 0, opened.article > 0)
        keeps = not drops and (tag in _MAIN or attributes.get("role", "").lower() in _MAIN)
        if keeps:
            close()
        opened.push(tag, drops, keeps)
    if not opened.furniture:
        words.append(page[max(at, last):].partition("<!--")[0])
    close()
    return out


_PARSED = "page_id long, url string, blocks array<struct<sure:boolean,line:string,n:int>>"


def _numbered(blocks: list[tuple[bool, str]]) -> list[dict]:
    """The blocks, each with the number of open ones before it."""
    before = itertools.accumulate((not sure for sure, _ in blocks), initial=0)
    return [{"sure": sure, "line": line, "n": n} for (sure, line), n in zip(blocks, before)]


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        frame["blocks"] = [_numbered(_blocks(p)) if p else [] for p in frame["html"].where(frame["html"].notna(), None)]
        yield frame[["page_id", "url", "blocks"]].astype({"page_id": "Int64"})


def _lcs_rows(x: list[str], places: dict[str, int], full: int, row: int) -> Iterator[int]:
    """Rows of the bit-parallel LCS table: a zero bit where the length grows by one."""
    for v in x:
        hit = row & places[v]
        row = ((row + hit) | (row - hit)) & full
        yield row


def _shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Rows of the table are bit sets, and only every n-th row is kept (n is the
    root of their number); the rows between are made again on the way back. So
    pages of very many lines need little memory.
    """
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    out = set(range(lo))
    y = b[lo:]
    common = set(y)
    x = [(i + lo, v) for i, v in enumerate(a[lo:]) if v in common]
    have = {v for _, v in x}
    y = [v for v in y if v in have]
    places = dict.fromkeys(have, 0)
    for j, v in enumerate(y):
        places[v] |= 1 << j
    full = (1 << len(y)) - 1
    step = math.isqrt(len(x)) + 1
    lines = [v for _, v in x]
    kept = [full]
    for start in range(0, len(x), step):
        row = kept[-1]
        for row in _lcs_rows(lines[start: start + step], places, full, row):
            pass
        kept.append(row)
    j = len(y)
    for part in range(len(kept) - 2, -1, -1):
        start = part * step
        rows = [kept[part], *_lcs_rows(lines[start: start + step], places, full, kept[part])]
        i = len(rows) - 1
        while i and j:
            if rows[i] >> (j - 1) & 1:  # no longer with the last line of b
                j -= 1
            elif not rows[i - 1] >> (j - 1) & 1:  # no longer with this line of a
                i -= 1
            else:
                i, j = i - 1, j - 1
                out.add(x[start + i][0])
    return out


@F.pandas_udf(ArrayType(BooleanType()))
def _furniture_mask(mine: pd.Series, other: pd.Series) -> pd.Series:
    """For each open block: is it aligned with one of the partner page?"""
    out = []
    for a, b in zip(mine, other):
        a = [] if a is None else list(a)
        hit = set() if b is None else _shared_lines(a, list(b))
        out.append([i in hit for i in range(len(a))])
    return pd.Series(out, index=mine.index)


def _common_prefix(a: Column, b: Column) -> Column:
    """Characters that two paths share from the start (null counts as none)."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(a.isNull() | b.isNull(), F.lit(0)).otherwise(F.when(first > 0, first - 1).otherwise(F.length(a)))


def _partners(keys: DataFrame) -> DataFrame:
    """(host, said, partner): the neighbour by path, of the same host, that shares the longer path prefix."""
    place = F.struct("host", "path", "said")
    # Written, so that a row's part is fixed; the parts follow each other in the order of host and path.
    parts = materialise(keys.repartitionByRange("host", "path", "said").withColumn("part", F.spark_partition_id()), "page-order")
    beside = Window.orderBy("part")  # one row a part
    ends = parts.groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last")).select(
        "part", F.lag("last").over(beside).alias("left"), F.lead("first").over(beside).alias("right"))
    near = Window.partitionBy("part").orderBy("host", "path", "said")
    placed = (parts.withColumn("b", F.lag(place).over(near)).withColumn("a", F.lead(place).over(near))
              .join(F.broadcast(ends), "part").withColumn("b", F.coalesce("b", "left")).withColumn("a", F.coalesce("a", "right"))
              .withColumn("before", F.when(F.col("b.host") == F.col("host"), F.col("b")))
              .withColumn("after", F.when(F.col("a.host") == F.col("host"), F.col("a"))))
    partner = F.when(_common_prefix(F.col("path"), F.col("after.path")) > _common_prefix(F.col("path"), F.col("before.path")),
                     F.col("after")).otherwise(F.coalesce("before", "after"))
    return placed.select("host", "said", partner["said"].alias("partner")).where("partner is not null")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    parsed = materialise(pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                                      F.col(page).cast("string").alias("html")).mapInPandas(_parse, _PARSED), "page-blocks")
    has_open = F.exists("blocks", lambda b: ~b["sure"])
    path = F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    lines = F.transform(F.filter("blocks", lambda b: ~b["sure"]), lambda b: b["line"])
    rows = parsed.where(has_open).withColumn("host", F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))).withColumn("said", F.xxhash64(lines))
    # Pages with open blocks, by host and path.
    open_pages = rows.where("url is not null").select("host", "said", path.alias("path"), lines.alias("lines"))
    # Pages of a host that say the same are one page, standing at their first path: copies are no furniture of each other.
    open_pages = open_pages.groupBy("host", "said").agg(
        F.min(F.struct("path", "lines")).alias("p")).select("host", "said", "p.path", "p.lines")
    open_pages = materialise(open_pages, "page-open")
    partners = _partners(open_pages.select("host", "path", "said"))
    other = open_pages.select("host", F.col("said").alias("partner"), F.col("lines").alias("other"))
    masks = (open_pages.select("host", "said", "lines").join(partners, ["host", "said"]).join(other, ["host", "partner"])
             .select("host", "said", _furniture_mask("lines", "other").alias("mask")))
    # Copies of one page may be very many: each page's mask stands once in every part.
    masks = materialise(masks, "page-furniture").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    marked = (rows.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
              .join(masks, ["host", "said", "part"], "left").select("page_id", "url", "blocks", "mask"))
    out = marked.unionByName(parsed.where(~has_open).withColumn("mask", F.lit(None).cast("array<boolean>")))
    # What is sure or not shared stays.
    kept = F.when(F.col("mask").isNull(), F.col("blocks")["line"]).otherwise(F.transform(F.filter(
        "blocks", lambda b: b["sure"] | ~F.get("mask", b["n"])), lambda b: b["line"]))
    return out.select("page_id", "url", F.array_join(kept, "\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
