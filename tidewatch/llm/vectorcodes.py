"""Vector code compression: product codes from memoised grid cells.

Each component x becomes the integer floor(scale * x). A vector is cut into
``PARTS`` equal consecutive parts, each with a codebook of up to ``ENTRIES``
entries that starts from the first vectors by id. A round assigns every part to
the nearest entry (squared distance, ties to the lower index) and moves each
entry to the floored mean of its parts; entries without parts stay.

The nearest entry is found through coarse grid cells. A part lies in the cell
whose coordinates are its components shifted right by ``CELL_BITS``. Over the
cell's box an entry has a least and a greatest distance; an entry whose least
distance exceeds the smallest greatest distance of any entry can be nearest
nowhere in the box (it is dominated). What is left is remembered under the
cell's hash key, so parts that fall into a known cell evaluate only those
entries, exactly. The memory is bounded (``MAX_CELLS``) and holds for one
codebook; emptying it costs time, never a result.

Vectors stay in the tasks. A round sends per task and entry the sums of its
parts, which Spark adds up; the driver holds the codebooks alone (``ENTRIES``
times the vector width). Equal labels are summed by an aggregate and joined
back behind a size check.

Defined results: a vector that is null or has a null, NaN or infinite component
is dropped; scaled components saturate at ``LIMIT`` in size, so that squared
distances stay in a long; vectors are as wide as the widest kept one, up to a
multiple of ``PARTS``, and shorter ones (an empty one too) are filled up with
zeros; rows that repeat an id are rows of their own; of equal ids the smaller
integer vector comes first, a null id last; with fewer than ``ENTRIES`` kept
vectors the codebooks are that much shorter; an empty table gives an empty
result and empty codebooks. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ship
from tidewatch.operators.joins import bounded_broadcast, materialise

ship(__name__)

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CELL_BITS = 6  # a cell is 64 integer steps wide, 1/16 of a unit at the default scale
MAX_CELLS = 50_000
LIMIT = 1 << 24
_PIECE = 2048  # parts that are worked on together


@dataclass
class Coded:
    """``rows``: id, label, code, error; ``books``: per part the final entries, as rows of integers."""

    rows: DataFrame
    books: list[np.ndarray]

    def books_sha256(self) -> str:
        """Hash of all entries' components, in order, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


class Cells:
    """Nearest entries of one codebook, through remembered cells."""

    def __init__(self, book: np.ndarray, bits: int = CELL_BITS, max_cells: int = MAX_CELLS):
        self.book, self.bits, self.max_cells = book, bits, max_cells
        self.known: dict[bytes, np.ndarray] = {}
        self.evaluated = self.reused = 0  # distances computed, cells found again

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell (a row of coordinates) the entries that can be nearest in its box, ascending."""
        least = np.zeros((len(cells), len(self.book)), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            coords, where = np.unique(cells[:, d], return_inverse=True)
            low = coords[:, None] << self.bits
            high = low + (1 << self.bits) - 1
            e = self.book[None, :, d]
            near = np.maximum(np.maximum(low - e, e - high), 0)
            far = np.maximum(np.abs(e - low), np.abs(e - high))
            least += (near * near)[where]
            most += (far * far)[where]
        keep = least <= most.min(axis=1, keepdims=True)
        return np.split(np.nonzero(keep)[1].astype(np.int32), np.cumsum(keep.sum(axis=1))[:-1])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``parts``."""
        if parts.shape[1] == 0:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        cells = np.ascontiguousarray(parts >> self.bits)
        keys = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        names = [k.tobytes() for k in distinct]
        if len(self.known) + len(names) > self.max_cells:
            self.known.clear()
        new = [i for i, k in enumerate(names) if k not in self.known]
        self.reused += len(names) - len(new)
        if new:
            for i, found in zip(new, self._undominated(cells[first[new]])):
                self.known[names[i]] = found
        lists = [self.known[k] for k in names]
        sizes = np.array([len(x) for x in lists])
        flat, at = np.concatenate(lists), np.concatenate([[0], np.cumsum(sizes)])
        # Row by row the remembered entries of its cell, one below the other.
        n = sizes[which]
        row = np.repeat(np.arange(len(parts)), n)
        starts = np.cumsum(n) - n
        entry = flat[np.arange(len(row)) - np.repeat(starts - at[which], n)]
        diff = parts[row] - self.book[entry]
        dist = np.einsum("ij,ij->i", diff, diff)
        self.evaluated += len(row)
        best = np.minimum.reduceat(dist, starts)
        hit = np.flatnonzero(dist == best[row])
        _, lowest = np.unique(row[hit], return_index=True)
        return entry[hit[lowest]].astype(np.int64), best


def _assigned(values: pa.Array, books: list[np.ndarray], cells: list[Cells]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, parts as rows x PARTS x width, entries, distances), piece by piece."""
    width = sum(b.shape[1] for b in books)
    for start in range(0, len(values), _PIECE):
        piece = values[start:start + _PIECE]
        parts = piece.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(piece), PARTS, width // PARTS)
        entry, dist = np.empty((2, len(piece), PARTS), np.int64)
        for p in range(PARTS):
            entry[:, p], dist[:, p] = cells[p].nearest(np.ascontiguousarray(parts[:, p]))
        yield start, parts, entry, dist


def _sums(books: list[np.ndarray], bits: int):
    """Per task: how many parts each entry has and the sums of their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, bits) for b in books]
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for _, parts, entry, _ in _assigned(batch.column("q"), books, cells):
                for p in range(PARTS):
                    order = np.argsort(entry[:, p], kind="stable")
                    found, first = np.unique(entry[order, p], return_index=True)
                    counted = np.concatenate([parts[order, p], np.ones((len(order), 1), np.int64)], axis=1)
                    total[p][found] += np.add.reduceat(counted, first, axis=0)
        for p, t in enumerate(total):
            used = np.flatnonzero(t[:, -1])
            if len(used):
                # One row per entry and place: the last place is the count.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(t[used].size, p, np.int32)), pa.array(np.repeat(used, t.shape[1]).astype(np.int32)),
                     pa.array(np.tile(np.arange(t.shape[1], dtype=np.int32), len(used))), pa.array(t[used].ravel())],
                    names=["part", "entry", "place", "total"])

    return run


def _codes(books: list[np.ndarray], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, bits) for b in books]
        for batch in batches:
            for start, parts, entry, dist in _assigned(batch.column("q"), books, cells):
                n = len(entry)
                hexed = entry.astype(np.uint8).tobytes().hex()
                codes = [hexed[i:i + 2 * PARTS] for i in range(0, len(hexed), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id")[start:start + n], batch.column("label")[start:start + n], pa.array(codes),
                     pa.array(dist.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return run


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label and the scaled integer vector ``q`` of the rows that can be coded."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    # Cut to twice the limit before the floor, which a long must hold, and to the limit after it.
    within = lambda x, limit: F.greatest(F.lit(-limit), F.least(F.lit(limit), x))
    scaled = F.transform("v", lambda x: within(F.floor(within(x.cast("double") * scale, 2.0 * LIMIT)), LIMIT).cast("int"))
    return rows.where(F.col("v").isNotNull() & finite).select("vec_id", "label", scaled.alias("q"))


def encode(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS,
           scale: int = SCALE, cell_bits: int = CELL_BITS) -> Coded:
    """Codes of all vectors that can be coded, with the codebooks."""
    spark = df.sparkSession
    kept = materialise(integer_vectors(df, vec_id, vector, label, scale), "vector-parts")
    widest = kept.agg(F.max(F.size("q"))).first()[0] or 0
    width = -(-widest // PARTS) * PARTS
    if kept.where(F.size("q") != width).limit(1).count():
        kept = kept.withColumn("q", F.concat("q", F.array_repeat(F.lit(0), F.lit(width) - F.size("q"))))
    start = [r.q for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(ENTRIES).select("q").collect()]
    first = np.array(start, np.int64).reshape(len(start), width)
    books = [np.ascontiguousarray(b) for b in np.split(first, PARTS, axis=1)]
    for _ in range(rounds if start else 0):
        sums = kept.select("q").mapInArrow(_sums(books, cell_bits), "part int, entry int, place int, total long")
        moved: dict[tuple[int, int], dict[int, int]] = {}
        # At most PARTS * ENTRIES * (width / PARTS + 1) rows, whatever the table's size.
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
            moved.setdefault((r.part, r.entry), {})[r.place] = r.total
        books = [b.copy() for b in books]
        for (p, e), t in moved.items():
            books[p][e] = [t[d] // t[width // PARTS] for d in range(width // PARTS)]
    kinds = dict(kept.dtypes)
    rows = kept.mapInArrow(_codes(books, cell_bits), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return Coded(rows, books)


def with_label_errors(coded: Coded) -> DataFrame:
    """vec_id, label, code, error and ``label_error``: the errors of equal labels (nulls together) added up."""
    rows = materialise(coded.rows, "vector-codes")
    totals = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(bounded_broadcast(totals), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
