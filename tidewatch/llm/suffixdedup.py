"""Repeated byte strings by a distributed difference-cover suffix array.

Every byte that some ``length``-byte string covers which also starts elsewhere,
in the same or another text, is removed.

**What is sorted.** A suffix array of all bytes would not fit a cluster's disks
beside its input, and most suffixes have nothing to meet. So the windows (the
``length``-byte strings) are dealt out first. Each window has an anchor: of the
``CORE``-byte strings inside it the one with the smallest hash, the last of
equal ones. The anchor depends on the window's bytes alone, so equal windows
have equal anchors at equal places. Consecutive windows with one anchor form a
passage: the anchor's core and up to ``length - CORE`` bytes on either side.
Only passages whose core occurs again can hold a repeat; equal passages are one
(all their windows are repeated), and what is left is grouped by core, since
windows with different cores differ.

**How it is sorted.** Passages of equal cores come to one task, which builds
the suffix array of its passages by the difference cover modulo 3: suffixes at
places 1 and 2 modulo 3 are sorted by their triples and named, the names are
sorted by recursion while any repeats, and the suffixes at places 0 modulo 3
are merged in. Neighbours in that order are then compared on
their first ``length`` bytes.

**Skew.** A core's passages are counted over all tasks. Beyond ``GROUP`` of
them the group is halved: windows with the anchor in their left half share more
bytes to the right of it, the others more bytes to its left, so each half is
grouped by longer common bytes, until the groups are small. Passages that only
differed outside a half are equal in it: all their windows are repeated, and one
of them goes on, so many passages with a long part in common stay about as many
rows a halving, not a row for each window. A core that a task meets again needs
no partner elsewhere, so such rows are spread over ``SALTS`` keys, and equal
passages of a task are one row. Copies of a text are worked on once a batch, bring
their passages to the sort once, and get each repeated window once, however many
they are. No row is dropped.

Defined results: texts are whole UTF-8 bytes; a null or empty text has no bytes
and stays; a text shorter than ``length`` loses nothing; texts of any length
are worked on in pieces that overlap by a window; rows that repeat a document
repeat its bytes, so copies of at least ``length`` bytes lose all; a null id
stays null; an empty table gives an empty result. Further columns are not read.
Windows are known by 128 bits of hashes where whole passages are compared, and
by their bytes in the suffix array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import ship, text_of
from tidewatch.operators.joins import materialise

ship(__name__)

LENGTH = 200
CORE = 64
GROUP = 4096  # passages of one core that one task sorts at most
SALTS = 4096
PIECE = 1 << 18  # bytes of one numpy step; also the places that fit a sort key
TASK_BYTES = 1 << 20  # bytes after which a suffix array is full

_U = np.uint64
_ALL = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))


def _power(e: int) -> np.uint64:
    return _U(pow(_P, e, 1 << 64))


def _window_hashes(data: np.ndarray, width: int, widths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hash of the ``width`` bytes from each place on, for each of ``widths``, by joining halves."""
    out: dict[int, np.ndarray] = {}
    doubled, size = _BYTE[data], 1
    parts = {w: (None, 0) for w in widths}
    while size <= width:
        for w in widths:
            if w & size:
                have, n = parts[w]
                if have is None:
                    parts[w] = (doubled, size)
                else:
                    m = max(len(data) - n - size + 1, 0)
                    parts[w] = (have[:m] * _power(size) + doubled[n:n + m], n + size)
        m = max(len(data) - 2 * size + 1, 0)
        doubled = doubled[:m] * _power(size) + doubled[size:size + m]
        size *= 2
    for w, (h, _) in parts.items():
        out[w] = _mix(h[:max(len(data) - w + 1, 0)])
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(x) - width + 1
    return low[:n] if size == width else np.minimum(low[:n], low[width - size:width - size + n])


def _passages(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor - first, core hash, passage hash) of the texts data[at[r]:at[r + 1]]."""
    n = len(data) - length + 1
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),) * 2
    if n <= 0:
        return none
    hashes = _window_hashes(data, length, (CORE, length))
    bits = int(len(data)).bit_length()
    low = _U((1 << bits) - 1)
    # Smallest hash first; of equal ones the last place.
    keys = (_mix(hashes[CORE]) & ~low) | (low - np.arange(len(hashes[CORE]), dtype=_U))
    anchor = (low - (_sliding_min(keys, length - CORE + 1) & low)).astype(np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
    ok = np.flatnonzero(np.arange(n) + length <= at[text + 1])
    if not len(ok):
        return none
    a, t = anchor[ok], text[ok]
    begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])]))
    last = np.concatenate([begin[1:], [len(ok)]]) - 1
    first, end, a, t = ok[begin], ok[last], a[begin], t[begin]
    windows, off = end - first + 1, a - first
    whole = _mix(hashes[length][first] + _mix(hashes[length][end] + (windows << 16 | off).astype(_U)))
    return t, first - at[t], windows, off, hashes[CORE][a], whole


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(text, its byte at the piece's start, bytes) in runs of about ``PIECE`` bytes; long texts overlap by a window."""
    rows, starts, parts, size = [], [], [], 0
    for r, t in enumerate(texts):
        for s in range(0, max(len(t) - length + 1, 0), PIECE):
            part = t[s:s + PIECE + length - 1]
            rows.append(r)
            starts.append(s)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield rows, starts, parts
                rows, starts, parts, size = [], [], [], 0
    if parts:
        yield rows, starts, parts


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_ANCHORS = "key long, bytes int, first long, windows int, off int, core long, whole long, copies int, slot int"


def _anchored(length: int):
    """Passages of a task's texts, of equal texts once. Of equal passages the first has their number as ``copies``, the others have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId()
        for batch in batches:
            key, size = batch.column("key").to_numpy(), batch.column("bytes").to_numpy()
            # Copies of a text bring its passages once, as often as there are copies.
            _, one, copies = np.unique(np.stack([key, size], axis=1), axis=0, return_index=True, return_counts=True)
            texts = [batch.column("text")[i].as_buffer().to_pybytes() for i in one.tolist()]
            key, size = key[one], size[one]
            found = []
            for rows, starts, parts in _pieces(texts, length):
                data = np.frombuffer(b"".join(parts), np.uint8)
                at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                t, first, windows, off, core, whole = _passages(data, at, length)
                r = np.array(rows)[t]
                found.append((key[r], size[r], first + np.array(starts)[t], windows.astype(np.int32), off.astype(np.int32), _signed(core), _signed(whole), copies[r]))
            if not found:
                continue
            k, b, first, windows, off, core, whole, times = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((whole, core))
            c, w, times = core[order], whole[order], times[order]
            new_core = np.concatenate([[True], c[1:] != c[:-1]])
            new = new_core | np.concatenate([[True], w[1:] != w[:-1]])
            begin = np.flatnonzero(new)
            n_equal = np.zeros(len(order), np.int32)
            n_equal[begin] = np.add.reduceat(times, begin)
            # Slot 0: the first passage of a core, for the comparison with other tasks; -1: known to be repeated.
            met = (np.add.reduceat(times, np.flatnonzero(new_core)) > 1)[np.cumsum(new_core) - 1]
            slot = np.where(new_core, np.where(met, -1, 0), 1 + (salt + np.arange(len(order))) % SALTS).astype(np.int32)
            columns = (k[order], b[order], first[order], windows[order], off[order], c, w, n_equal, slot)
            for s in range(0, len(order), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[s:s + 100_000]) for x in columns],
                                                 names=[x.split()[0] for x in _ANCHORS.split(", ")])

    return run


# --- suffix arrays


def _ranks(s: np.ndarray) -> np.ndarray:
    """Rank of each suffix of ``s`` (positive numbers), by the difference cover modulo 3."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    padded = np.concatenate([s, np.zeros(3, np.int64)])
    base = int(s.max()) + 1
    # With n = 1 modulo 3 place n counts too: a filler that ends the names of places 1.
    sampled = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    triples = (padded[sampled] * base + padded[sampled + 1]) * base + padded[sampled + 2]
    values, names = np.unique(triples, return_inverse=True)
    order_of = names + 1 if len(values) == len(sampled) else _ranks(names + 1) + 1
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = order_of
    # The others sort by their first number and the rank of the next place.
    other = np.arange(0, n, 3)
    width = len(sampled) + 2
    other = other[np.argsort(padded[other] * width + rank[other + 1], kind="stable")]
    by_rank = sampled[np.argsort(rank[sampled], kind="stable")]
    by_rank = by_rank[by_rank < n]
    one, two = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    before = np.searchsorted(padded[one] * width + rank[one + 1], padded[other] * width + rank[other + 1])
    before += np.searchsorted((padded[two] * base + padded[two + 1]) * width + rank[two + 2],
                              (padded[other] * base + padded[other + 1]) * width + rank[other + 2])
    place = np.empty(n, np.int64)
    at = before + np.arange(len(other))
    place[other] = at
    free = np.ones(n, bool)
    free[at] = False
    place[by_rank] = np.flatnonzero(free)
    return place


def repeated_windows(passages: list[bytes], windows: list[int], length: int) -> list[np.ndarray]:
    """Per passage, which of its first ``windows`` places start a ``length``-byte string that another such place starts too."""
    lens = np.array([len(p) for p in passages])
    at = np.concatenate([[0], np.cumsum(lens + 1)])
    text = np.frombuffer(b"\0".join(passages) + b"\0" * 8, np.uint8)
    n = int(at[-1])
    symbols = text[:n].astype(np.int64) + 2
    symbols[at[1:] - 1] = 1  # below all bytes
    rank = _ranks(symbols)
    n_w = np.array(windows)
    starts = np.repeat(at[:-1], n_w) + np.arange(n_w.sum()) - np.repeat(np.cumsum(n_w) - n_w, n_w)
    order = np.argsort(rank[starts])
    s = starts[order]
    # Neighbours whose first ``length`` bytes are equal, eight bytes at a time.
    words = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1))
    same, here, there = np.arange(len(s) - 1), s[:-1], s[1:]
    for d in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        equal = (words[here[same] + d] == words[there[same] + d]).all(axis=1)
        same = same[equal]
    hit = np.zeros(len(s), bool)
    hit[same] = hit[same + 1] = True
    out = np.zeros(len(s), bool)
    out[order] = hit
    return np.split(out, np.cumsum(n_w)[:-1])


_FOUND = "key long, bytes int, first long, last long"


def _runs(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _sorted_windows(length: int):
    """Repeated windows of the passages of a partition; rows of one core follow each other."""
    def flush(rows: dict[tuple, tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        hits = repeated_windows([r[3] for r in rows.values()], [r[4] for r in rows.values()], length)
        out: list[list] = [[], [], [], []]
        for (key, size, first, _, _), h in zip(rows.values(), hits):
            for a, b in zip(*_runs(h)):
                for x, v in zip(out, (key, size, first + int(a), first + int(b) - 1)):
                    x.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.int64())], names=[x.split()[0] for x in _FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple, tuple] = {}
        size, last, begun = 0, None, 0
        for batch in batches:
            for g, whole, lo, key, b, first, passage, windows in zip(*(batch.column(c).to_pylist() for c in (
                    "g", "whole", "lo", "key", "bytes", "first", "passage", "windows"))):
                if g != last:
                    if len(rows) == begun + 1:  # alone in its group
                        size -= len(rows.popitem()[1][3])
                    if size >= TASK_BYTES:
                        yield from flush(rows)
                        rows, size = {}, 0
                    last, begun = g, len(rows)
                rows[g, whole, lo] = (key, b, first, passage, windows)
                size += len(passage)
        yield from flush(rows)

    return run


# --- the operator


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Equal texts have equal results, so a text is known by its hash and length."""
    t = text_of(text)
    return docs.select(F.col(doc_id).alias("doc_id"), t.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("key"), F.octet_length("text").alias("bytes"), F.encode("text", "UTF-8").alias("text"))


def _span() -> list:
    return ["key", "bytes", "first", (F.col("first") + F.col("windows") - 1).alias("last")]


def _narrowed(rows: DataFrame, length: int, group: int) -> tuple[DataFrame, DataFrame | None]:
    """Passages in groups of at most ``group``, and windows that need no sort.

    A row's windows have their anchor ``lo`` to ``hi`` bytes on. Where a group is
    too large, both halves of that range become rows of their own, grouped by
    the bytes that all windows of the half share. Rows that are equal in a half
    have all its windows repeated; one of them is compared with the others.
    """
    done = alone = None
    same = ["g", "off", "windows", "passage"]
    while True:
        # One window each: its bytes are the group, so a row has nothing left to differ in.
        big = rows.where("lo < hi").groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("g")
        big, n_big = materialise(big, "core-groups", counted=True)
        if not n_big:
            return (rows if done is None else done.unionByName(rows)), alone
        small = rows.join(big, "g", "left_anti")
        large = rows.join(big, "g", "left_semi")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = large.withColumn("half", F.explode(F.array(
            F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi").alias("hi")))))
        # Windows of the half: the anchor stands off - place bytes into window ``place``.
        a, b = F.greatest(F.lit(0), F.col("off") - F.col("half.hi")), F.least(F.col("windows") - 1, F.col("off") - F.col("half.lo"))
        halves = halves.withColumn("a", a).withColumn("b", b).where("a <= b").select(
            F.xxhash64("g", "half", F.substring(F.col("passage"), F.col("off") - F.col("half.lo") + 1,
                                                F.lit(length) - F.col("half.hi") + F.col("half.lo"))).alias("g"),
            "whole", "key", "bytes", (F.col("first") + F.col("a")).alias("first"), (F.col("b") - F.col("a") + 1).alias("windows"),
            (F.col("off") - F.col("a")).alias("off"), F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"),
            F.substring(F.col("passage"), F.col("a") + 1, F.col("b") - F.col("a") + F.lit(length)).alias("passage"))
        halves = materialise(halves, "core-halves")
        kinds = halves.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("whole", "key", "bytes", "first", "lo", "hi")).alias("one"))
        kinds = materialise(kinds, "half-kinds")
        equal = halves.join(kinds.where("n > 1").select(*same), same, "left_semi").select(*_span())
        done = small if done is None else done.unionByName(small)
        alone = equal if alone is None else alone.unionByName(equal)
        rows = kinds.select("one.*", *same)


def repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(key, bytes, first, last): windows ``first`` to ``last`` of the text are repeated. ``docs`` as from ``_keyed``."""
    # Three names of a suffix array must fit a long: its text stays below 3 << 20 bytes.
    group = max(1, min(group, (1 << 21) // (2 * length)))
    anchors = docs.where(F.col("bytes") >= length).select("key", "bytes", "text").mapInArrow(_anchored(length), _ANCHORS)
    # A core that a task has twice is shared (-1, or a salt); others are compared over all tasks.
    anchors = anchors.withColumn("known", F.col("slot") != 0).withColumn("slot", F.greatest("slot", F.lit(0)))
    met = F.sum(F.when(F.col("known"), 2).otherwise(1)).over(Window.partitionBy("core", "slot"))
    shared = materialise(anchors.withColumn("met", met).where("met > 1").drop("met", "slot", "known"), "shared-passages")
    # Equal passages: all windows are repeated; a single one of a core with others is sorted.
    kinds = shared.where("copies > 0").groupBy("core", "whole").agg(
        F.sum("copies").alias("n"), F.min(F.struct("key", "bytes", "first", "windows", "off")).alias("one"))
    kinds = materialise(kinds, "passage-kinds")
    many = kinds.where("n > 1").select("core", "whole")
    span = _span()
    # What a task has met twice is known already; a frequent passage is then one row a task in the join.
    equal = shared.where("copies <> 1").select(*span).unionByName(
        shared.where("copies = 1").join(many, ["core", "whole"], "left_semi").select(*span))
    mixed = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core")
    wanted = kinds.join(mixed, "core", "left_semi").select("core", "whole", "one.*")
    per_text = wanted.groupBy("key", "bytes").agg(F.collect_list(F.struct("core", "whole", "first", "windows", "off")).alias("w"))
    texts = docs.where(F.col("bytes") >= length).groupBy("key", "bytes").agg(F.first("text").alias("text"))
    cut = texts.join(per_text, ["key", "bytes"]).select("key", "bytes", "text", F.explode("w").alias("w")).select(
        F.col("w.core").alias("g"), "w.whole", "key", "bytes", "w.first", "w.windows", "w.off", F.lit(0).alias("lo"), F.lit(length - CORE).alias("hi"),
        F.substring(F.col("text"), (F.col("w.first") + 1).cast("int"), F.col("w.windows") + F.lit(length - 1)).alias("passage"))
    grouped, alone = _narrowed(materialise(cut, "passages"), length, group)
    found = grouped.repartition("g").sortWithinPartitions("g", "whole", "lo").mapInArrow(_sorted_windows(length), _FOUND)
    found = found.unionByName(equal)
    return found if alone is None else found.unionByName(alone)


def _per_text(found: DataFrame) -> DataFrame:
    """The repeated windows of each text, once each: copies of it, and passages of several groups, bring them again."""
    return found.groupBy("key", "bytes").agg(F.collect_set(F.struct("first", "last")).alias("w"))


def _cut(length: int, kind: str):
    """What stays of each text without the bytes its repeated windows cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, windows in zip(batch.column("text"), batch.column("w")):
                text = text.as_buffer().to_pybytes()
                n_spans, start, out = 0, 0, []
                if windows.is_valid:
                    found = windows.values
                    first, last = (found.field(c).to_numpy() for c in ("first", "last"))
                    order = np.argsort(first, kind="stable")
                    first, end = first[order], np.maximum.accumulate(last[order] + length)
                    new = np.concatenate([[True], first[1:] > end[:-1]])
                    n_spans = int(new.sum())
                    for a, b in zip(first[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()):
                        out.append(text[start:a])
                        start = b
                out.append(text[start:])
                kept.append(b"".join(out))
                removed.append(len(text) - len(kept[-1]))
                spans.append(n_spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("bytes").cast(pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in kept]) if kind == "digest" else pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if kind == "digest" else "kept"])

    return run


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, digest: bool = False, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the bytes that stay (``kept``) or their hash."""
    keyed = _keyed(docs, doc_id, text)
    kind = dict(keyed.dtypes)["doc_id"]
    return keyed.join(_per_text(repeats(keyed, length, group)), ["key", "bytes"], "left").select("doc_id", "bytes", "text", "w").mapInArrow(
        _cut(length, "digest" if digest else "bytes"),
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digest else "kept binary"))
