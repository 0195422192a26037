"""Benchmark decontamination by q-gram lemma filtering.

Both sides are normalised alike: lower case, every run of white space one
space, trimmed. For an item of m characters the edit budget is
k = floor(EDIT_SHARE * m). By the q-gram lemma, a document region within k
edits of the item shares at least m + 1 - q - k * q of the item's character
q-grams, all on k + 1 neighbouring diagonals (document position minus item
position). Diagonals are counted in bands of 2(k + 1), each overlapping the
next by half, so every such set of diagonals lies inside one band. Bands that
reach the bound are kept as candidate regions and confirmed by a banded
alignment of the whole item against the region.

The items are the query set: they are indexed in blocks of bounded size
(``BLOCK_CHARS``), and every block is matched against all documents. Documents
are scanned where they lie; only candidate regions are moved.

Defined results: a null or empty document has no matches; a null item, or one
of fewer than ``MIN_CHARS`` normalised characters, has no evidence to offer
and matches nothing; equal items and repeated documents each give their own
rows; a budget too large for the lemma's bound is cut to the largest k for
which the bound is at least one. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ship
from tidewatch.operators.joins import materialise

ship(__name__)

Q = 12
EDIT_SHARE = 0.06
MIN_CHARS = 24
BLOCK_CHARS = 2_000_000  # characters of items in one broadcast index
PIECE_CHARS = 1 << 18
_FILTER_BITS = 22

_U = np.uint64
_P = 0x9E3779B97F4A7C15


def _lower_table() -> np.ndarray:
    """Code point -> its lower case where that is one code point; white space -> 32."""
    out = np.arange(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000:
            low = chr(c).lower()
            if chr(c).isspace():
                out[c] = 32
            elif len(low) == 1 and ord(low) < 0x10000:
                out[c] = ord(low)
    return out


_TABLE: list[np.ndarray] = []


def _normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(normalised code points, position of each in ``text``)."""
    if not _TABLE:
        _TABLE.append(_lower_table())
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.where(c < 0x10000, _TABLE[0][np.minimum(c, 0xFFFF)], c)
    space = low == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space after a character stays
    if len(keep):
        keep[0] = not space[0]
        if keep.any():
            last = len(keep) - 1 - int(np.argmax(keep[::-1]))
            if space[last]:
                keep[last] = False
    at = np.flatnonzero(keep)
    return low[at], at


def _grams(c: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each position on, by doubling."""
    if len(c) < Q:
        return np.zeros(0, _U)
    h, width, out, done = c.astype(_U), 1, None, 0
    rest = Q
    while rest:
        if rest & 1:
            out = h[: len(c) - Q + 1 + 0].copy() if out is None else (
                out * _U(pow(_P, width, 1 << 64)) + h[done: done + len(c) - Q + 1])
            done += width
        rest >>= 1
        if rest:
            h = h[:-width] * _U(pow(_P, width, 1 << 64)) + h[width:]
            width *= 2
    out = out * _U(0xD6E8FEB86659FD93)
    return out ^ (out >> _U(32))


def _budget(m: int) -> int:
    return max(0, min(int(EDIT_SHARE * m), (m - Q) // Q))


def _index(items: list[tuple[int, str]]) -> dict[str, np.ndarray]:
    """Sorted q-grams of a block of items, with a bit table in front."""
    ids, m, grams, owner, place = [], [], [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for key, text in items:
        c, _ = _normal(text)
        if len(c) >= MIN_CHARS:
            g = _grams(c)
            grams.append(g)
            owner.append(np.full(len(g), len(ids), np.int64))
            place.append(np.arange(len(g), dtype=np.int64))
            ids.append(key)
            m.append(len(c))
    g = np.concatenate(grams)
    order = np.argsort(g, kind="stable")
    unique, first = np.unique(g[order], return_index=True)
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[(unique >> _U(64 - _FILTER_BITS)).astype(np.int64)] = True
    return {"id": np.array(ids, np.int64), "m": np.array(m, np.int64), "k": np.array([_budget(x) for x in m], np.int64),
            "grams": unique, "start": np.append(first, len(g)), "owner": np.concatenate(owner)[order],
            "place": np.concatenate(place)[order], "table": table}


def _bands(ix: dict, c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, item, lowest diagonal) of the bands that reach the lemma's bound.

    ``c`` holds several texts one after the other; ``doc`` numbers them. A
    q-gram across two texts can only add a candidate, never lose one.
    """
    g = _grams(c)
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(ix["table"][(g >> _U(64 - _FILTER_BITS)).astype(np.int64)])
    if not len(at) or not len(ix["grams"]):
        return none, none, none
    slot = np.minimum(np.searchsorted(ix["grams"], g[at]), len(ix["grams"]) - 1)
    hit = ix["grams"][slot] == g[at]
    at, slot = at[hit], slot[hit]
    if not len(at):
        return none, none, none
    n = ix["start"][slot + 1] - ix["start"][slot]
    post = np.repeat(ix["start"][slot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    item = ix["owner"][post]
    diag = np.repeat(at, n) - ix["place"][post]
    # Each diagonal lies in its own band and in the one that began half a band before.
    band = np.floor_divide(diag, ix["k"][item] + 1)
    span = len(c) + int(ix["m"].max()) + 2
    key = np.concatenate([item * (2 * span) + band + span, item * (2 * span) + band - 1 + span])
    found, count = np.unique(key, return_counts=True)
    item, band = found // (2 * span), found % (2 * span) - span
    need = ix["m"][item] + 1 - Q - ix["k"][item] * Q
    good = count >= np.maximum(need, 1)
    item, band = item[good], band[good]
    low = band * (ix["k"][item] + 1)
    middle = np.clip(low + ix["m"][item] // 2, 0, len(c) - 1)
    return doc[middle], item, low


def _candidates(index):
    """Map batches of (doc_id, text) to candidate regions."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = index.value
        for frame in frames:
            ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
            group, size = [], 0
            for r in range(len(texts) + 1):
                if r == len(texts) or size > PIECE_CHARS:
                    if group:
                        yield _regions_of(ix, group)
                    group, size = [], 0
                if r < len(texts) and texts[r]:
                    group.append((ids[r], texts[r]))
                    size += len(texts[r])

    return run


_REGION = "doc_id long, item_key long, region string, positions binary"


def _regions_of(ix: dict, group: list) -> pd.DataFrame:
    parts = [_normal(t) for _, t in group]
    lengths = np.array([len(c) for c, _ in parts], np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    joined = np.concatenate([c for c, _ in parts])
    out = {"doc_id": [], "item_key": [], "region": [], "positions": []}
    if len(joined):
        doc, item, low = _bands(ix, joined, np.repeat(np.arange(len(group)), lengths))
        seen = set()
        for d, i, lo in zip(doc.tolist(), item.tolist(), low.tolist()):
            m, k = int(ix["m"][i]), int(ix["k"][i])
            # The band may straddle two texts: look at each text it touches.
            a, b = lo - 1, lo + 2 * (k + 1) + m + k + 1
            for e in (d - 1, d, d + 1):
                if 0 <= e < len(group):
                    x, y = max(a, int(begin[e])), min(b, int(begin[e + 1]))
                    if y - x >= m - k and (e, i, x, y) not in seen:
                        seen.add((e, i, x, y))
                        pos = parts[e][1][x - int(begin[e]): y - int(begin[e])]
                        out["doc_id"].append(group[e][0])
                        out["item_key"].append(int(ix["id"][i]))
                        out["region"].append(joined[x:y].tobytes().decode("utf-32-le", "surrogatepass"))
                        out["positions"].append(pos.astype(np.int64).tobytes())
    frame = pd.DataFrame(out, dtype=object)
    return frame.astype({"doc_id": "Int64", "item_key": "int64"})


def _align(item: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int]:
    """(least edits, end) of ``item`` against any part of ``region``, in a band.

    Cell e of a row is column row + e - (k + 1); the region holds the matched
    part plus slack, so the band spans the slack and k edits to either side.
    """
    m, n = len(item), len(region)
    width = max(n - m, 0) + 2 * k + 3
    off = k + 1
    cols = np.arange(width) - off
    step = np.arange(width)
    big = m + n + 1
    row = np.where((cols >= 0) & (cols <= n), 0, big)
    padded = np.concatenate([np.full(off + 1, -1, np.int64), region.astype(np.int64), np.full(width + m + 2, -1, np.int64)])
    for i in range(1, m + 1):
        j = cols + i  # column of each cell in this row
        cost = (padded[i + step] != item[i - 1]).astype(np.int64)  # region[j - 1]
        best = row + cost
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best = np.where((j >= 0) & (j <= n), best, big)
        best = np.minimum.accumulate(best - step) + step
        row = np.where((j >= 0) & (j <= n), best, big)
        if row.min() > k:
            return big, 0
    e = int(np.argmin(row))
    return int(row[e]), int(cols[e]) + m


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for doc, item_id, item, region, pos in zip(frame["doc_id"], frame["item_id"], frame["item"], frame["region"], frame["positions"]):
            c, pos = _normal(item)[0], np.frombuffer(pos, np.int64)
            r = np.frombuffer(region.encode("utf-32-le", "surrogatepass"), np.uint32)
            k = _budget(len(c))
            whole = region.find(c.tobytes().decode("utf-32-le", "surrogatepass"))
            if whole >= 0:  # aligns without an edit
                out.append((doc, item_id, int(pos[whole]), int(pos[whole + len(c) - 1]) + 1, 0, len(c)))
                continue
            edits, end = _align(c, r, k)
            if edits <= k and end > 0:
                _, back = _align(c[::-1], r[:end][::-1], k)
                out.append((doc, item_id, int(pos[max(end - back, 0)]), int(pos[end - 1]) + 1, edits, len(c)))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "start", "end", "edits", "item_chars"]).astype(
            {"doc_id": "Int64", "item_id": "Int64"})


_FOUND = "doc_id long, item_id long, start int, end int, edits int, item_chars int"


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, edits, item_chars): the best region of each document and item.

    Positions are code points of the document's text, end exclusive.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("item")).where(
        "item is not null").distinct().withColumn("item_key", F.xxhash64("item"))
    total = items.agg(F.sum(F.length("item"))).first()[0] or 0
    blocks = math.ceil(total / BLOCK_CHARS)
    parts = []
    for b in range(blocks):  # each block is bounded; all documents meet every block
        block = items.where(F.pmod(F.xxhash64("item", F.lit(3)), F.lit(blocks)) == b)
        index = spark.sparkContext.broadcast(_index([tuple(r) for r in block.select("item_key", "item").distinct().collect()]))
        parts.append(texts.mapInPandas(_candidates(index), _REGION))
    if not parts:
        return spark.createDataFrame([], _FOUND)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    found = materialise(found, "decontamination-regions")
    checked = found.join(items, "item_key").select("doc_id", "item_id", "item", "region", "positions").mapInPandas(_verify, _FOUND)
    return checked.groupBy("doc_id", "item_id").agg(
        F.min(F.struct("edits", "start", "end", "item_chars")).alias("m")).select(
        "doc_id", "item_id", "m.start", "m.end", "m.edits", "m.item_chars")
