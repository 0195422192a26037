"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is its distinct word shingles. Its signature has ``SYMBOLS``
MinHash symbols of ``BITS`` bits; the Hamming distance of two signatures is the
number of symbols that differ. Signatures are split into ``CHUNKS`` chunks by
pigeonhole: two that differ in fewer than ``CHUNKS * (CHUNK_ERRORS + 1)``
symbols have a chunk with at most ``CHUNK_ERRORS`` errors. The errors allowed
in a chunk are enumerated as symbols left out, so every such pair meets under
one of ``SYMBOLS`` equal keys: with 8 chunks of 4 and one error in each, all
pairs at distance 15 or less are found, and a pair of similarity 0.8 is missed
with probability (1 - 0.8192) ** 8 = 1.1e-6. What meets is confirmed on the
full sets. Before that, pairs that cannot be similar enough are left out by
size and by a parity sketch: each shingle flips one of ``SKETCH_BITS`` bits, so
the bits in which two sketches differ never outnumber the shingles that only
one of the sets has. That bound loses nothing.

Groups are never expanded into all pairs. Equal sets are one class first. Then
each key links its members to its smallest member, and confirmed links are
joined into components. Only members of a key that are not in its largest
component are then compared with the rest of the key, so no link between
different components is lost, and a large group of true copies costs its size.

Defined results: words are split at ASCII white space after lower-casing A-Z;
a text with fewer words than a shingle is one shingle of all of them; a null or
empty text has an empty set and is linked with nothing; rows that repeat a
doc_id are one document that has all their links; a null doc_id is never
linked, has no component and is kept. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ship
from tidewatch.operators.joins import materialise

ship(__name__)

SHINGLE = 5
THRESHOLD = 80  # per cent of the union
BITS = 64
CHUNKS, CHUNK_LEN, CHUNK_ERRORS = 8, 4, 1
SYMBOLS = KEYS = CHUNKS * CHUNK_LEN  # one symbol is left out of each key
SKETCH_BITS = 2048
PIECE_BYTES, PIECE_ROWS = 1 << 20, 512  # texts are worked on in pieces of at most about this size

_U = np.uint64
_LONGS = SKETCH_BITS // 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt))


_BYTE = _seeds(256, 11)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_XOR, _MUL = _seeds(SYMBOLS, 23), _seeds(SYMBOLS, 37) | _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Hasher:
    """Shingle hashes of a run of texts that lie in one byte buffer."""

    def __init__(self, shingle: int):
        self.k, self.pow, self.inv = shingle, _powers(_P, 0), _powers(_P_INV, 0)

    def sets(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of the distinct shingles, by row; text r is data[at[r]:at[r + 1]]."""
        n = len(data)
        if n > len(self.pow):
            self.pow, self.inv = _powers(_P, n + 1), _powers(_P_INV, n + 1)
        word = ~_IS_SPACE[data]
        first = np.zeros(n + 1, bool)
        first[at] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | first[1:n]
        end = word.copy()
        end[:-1] &= ~word[1:] | first[1:n]
        b, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
        if not len(b):
            return np.zeros(0, np.int64), np.zeros(0, _U)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[data] * self.pow[:n], out=sums[1:])
        words = _mix((sums[e] - sums[b]) * self.inv[b])
        row = np.searchsorted(at, b, "right") - 1
        # Fold up to k words from each word on; a text shorter than k keeps its one whole fold.
        counts = np.bincount(row, minlength=len(at) - 1)
        ends = np.cumsum(counts)
        starts = ends - counts
        take = np.minimum(counts, self.k)[row]
        valid = np.arange(len(b)) + take <= ends[row]
        h = words.copy()
        for j in range(1, self.k):
            more = words[np.minimum(np.arange(len(b)) + j, len(b) - 1)]
            h = np.where(j < take, h * _U(0xD6E8FEB86659FD93) + more, h)
        valid &= (counts[row] >= self.k) | (np.arange(len(b)) == starts[row])
        row, h = row[valid], _mix(h[valid] + take[valid].astype(_U))
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        return row[new], h[new]


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows with about PIECE_BYTES of text."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1)
        j = min(j, i + PIECE_ROWS, len(texts))
        yield i, j - i, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


def _signature_rows(shingle: int):
    def run(batches):
        hasher = _Hasher(shingle)
        for batch in batches:
            for i, n, data, at in _pieces(batch, 1):
                row, h = hasher.sets(data, at)
                size = np.bincount(row, minlength=n).astype(np.int64)
                full = np.flatnonzero(size)
                s1, s2 = np.zeros(n, _U), np.zeros(n, _U)
                keys = np.zeros((n, KEYS), _U)
                bits = np.bincount(row * SKETCH_BITS + (h & _U(SKETCH_BITS - 1)).astype(np.int64), minlength=n * SKETCH_BITS)
                longs = np.packbits((bits & 1).astype(np.uint8)).view(np.int64).reshape(n, _LONGS)
                if len(full):
                    where = (np.cumsum(size) - size)[full]
                    s1[full] = np.add.reduceat(h, where)
                    s2[full] = np.add.reduceat(_mix(h ^ _U(0x5851F42D4C957F2D)), where)
                    mins = np.empty((len(full), SYMBOLS), _U)
                    for k in range(SYMBOLS):
                        mins[:, k] = np.minimum.reduceat((h ^ _XOR[k]) * _MUL[k], where)
                    mins = _mix(mins)
                    for c in range(CHUNKS):
                        for out in range(CHUNK_LEN):
                            tag = c * CHUNK_LEN + out
                            key = np.full(len(full), tag + 1, _U)
                            for s in range(CHUNK_LEN):
                                if s != out:
                                    key = _mix(key * _U(0xD6E8FEB86659FD93) + mins[:, c * CHUNK_LEN + s])
                            keys[full, tag] = key
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(size), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     *(pa.array(np.ascontiguousarray(longs[:, k])) for k in range(_LONGS)),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * KEYS), pa.array(keys.view(np.int64).ravel()))],
                    names=["doc_id", "n", "s1", "s2", *(f"g{k}" for k in range(_LONGS)), "keys"])

    return run


_SIG = [f"g{k}" for k in range(_LONGS)]
_SIG_SCHEMA = "doc_id long, n long, s1 long, s2 long, " + ", ".join(f"{g} long" for g in _SIG) + ", keys array<long>"


def _set_rows(shingle: int):
    def run(batches):
        hasher = _Hasher(shingle)
        for batch in batches:
            for i, n, data, at in _pieces(batch, 1):
                row, h = hasher.sets(data, at)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))],
                    names=["id", "set"])

    return run


def _may_link(a: str, b: str, threshold: int) -> Column:
    """False only where the similarity is surely below the threshold.

    With sizes n and m, a similarity of t % leaves at most
    (n + m) * (100 - t) / (100 + t) shingles that only one set has.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{g}").bitwiseXOR(F.col(f"{b}.{g}"))) for g in _SIG), F.lit(0))
    return ((100 * n >= threshold * m) & (100 * m >= threshold * n)
            & (differ * (100 + threshold) <= (n + m) * (100 - threshold)))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n, s1, s2, parity sketch, keys of the signature); (n, s1, s2) names the whole set."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _signature_rows(shingle), _SIG_SCHEMA)


def _confirmed(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, shingle: int, threshold: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = (docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
             .join(ids, "id", "left_semi").select("id", "text"))
    sets = materialise(texts.mapInArrow(_set_rows(shingle), "id long, set array<long>"), "neardup-sets")
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    both = both.select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return both.where(100 * F.col("i") >= threshold * (F.col("t") - F.col("i"))).where("i > 0").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b): the smallest id reachable.

    Large-star and small-star steps in turn, each written to the shared
    folder, until the links are stars around the smallest ids.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            near = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = near.join(least, "a")
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialise(links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links")
    before = mark(edges)
    while before[0]:
        edges = materialise(star(star(edges, True), False), "component-links")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    sig = materialise(signatures(docs, doc_id, text, shingle), "neardup-signatures")
    # Equal sets are one class, named by its smallest doc_id.
    classes = sig.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("id"), F.first("keys").alias("keys"), *(F.first(g).alias(g) for g in _SIG))
    reps = materialise(classes, "neardup-classes")
    keys = reps.select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    keyed = materialise(keys.join(shared, "key"), "neardup-keys")  # members of keys with at least two

    # First each member against the smallest member of its keys.
    star = keyed.where("id != center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    side = reps.select("id", "n", *_SIG)
    close = (star.alias("p").join(side.alias("x"), F.col("p.a") == F.col("x.id"))
             .join(side.alias("y"), F.col("p.b") == F.col("y.id")).where(_may_link("x", "y", threshold))
             .select("p.a", "p.b"))
    close = materialise(close, "neardup-star")
    links = materialise(_confirmed(close, docs, doc_id, text, shingle, threshold), "neardup-links")
    comp = materialise(components(links), "neardup-components")

    # Then, in each key, what lies outside its largest component against all other components.
    member = (keyed.select("key", "id").join(comp, "id", "left")
              .select("key", "id", F.coalesce("component", "id").alias("comp")))
    per_key = member.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps")
    open_keys = materialise(member.join(per_key, "key").join(side, "id"), "neardup-open")
    pairs = (open_keys.where("comp != main").alias("x").join(open_keys.alias("y"), (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
        & _may_link("x", "y", threshold)))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    pairs = materialise(pairs.join(close, ["a", "b"], "left_anti"), "neardup-pairs")
    more = _confirmed(pairs, docs, doc_id, text, shingle, threshold)
    # Members of a class that share a doc_id with another class join both.
    same = sig.where("n > 0 and doc_id is not null").join(reps.select("n", "s1", "s2", "id"), ["n", "s1", "s2"])
    copies = same.where("doc_id != id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    comp = materialise(components(links.union(more).union(copies)), "neardup-components")
    out = sig.select("doc_id", F.col("n").alias("n_shingles")).join(
        comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
