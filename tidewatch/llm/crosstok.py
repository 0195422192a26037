"""Cross-tokenizer alignment: where two tokenizers cut a text at the same byte.

Both tokenizers encode the text; their tokens' byte ends are two ascending
lists. Galloping intersection finds the common ends: each end of the shorter
list doubles its step through the longer one until it is passed, and a binary
search in the last step finds it (all ends of many stretches at once). Common ends cut both token lists into groups;
differences of ranks (places) inside a group tell which tokens overlap. Tokens
that end a group together are linked, and each document's links are held
against the counts of their id pairs over all documents.

A text is encoded stretch by stretch: a stretch ends where a character that is
no white space meets a space. That is exact if no token of either tokenizer can
hold such a place: the byte-level tokenizer cuts there before its merges, and
of the piece tokenizer every piece is looked at when it is loaded. Otherwise
the whole text is one stretch. Equal stretches of a task are encoded and
aligned once (at most ``MAX_STRETCHES`` are remembered between blocks).

A task turns its documents into blocks of about ``BLOCK_CHARS`` characters: one
row with each document's figures and the block's distinct pairs. Pairs are
added up over blocks, so a pair that every document holds is one row a block,
and each block gets its own pairs' counts back by a join. Nothing is broadcast
or collected.

Defined results: a null or empty text has no tokens (zeros, ''), nor has a text
whose tokens' bytes of either tokenizer differ from space + text; texts of any
length are encoded whole; rows that repeat a document are documents of their
own and count as such; a null id stays null; an empty table gives an empty
result. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import ship, text_of
from tidewatch.operators.joins import materialise

ship(__name__)

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_CHARS = 2_000_000
MAX_STRETCHES = 400_000
_AT_ONCE = 2000  # stretches that one call of a library encodes

_CUT = re.compile(r"(?<=[^\s▁])(?= )")  # the piece tokenizer writes a space as U+2581
_JOINED = re.compile(r"[\s▁] ")


# --- alignment of two end lists


def gallop(ends: np.ndarray, longer: np.ndarray, low: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Per value of ``ends`` its place in the ascending ``longer`` between ``low`` and ``limit``, or -1 if it is not there.

    All values search at once: each doubles its step from ``low`` on until it
    is passed, then halves what is left of the last step.
    """
    if not len(longer):
        return np.full(len(ends), -1)
    low, high = low.copy(), low.copy()
    step, last = 1, len(longer) - 1
    on = np.flatnonzero((high < limit) & (longer[np.minimum(high, last)] < ends))
    while len(on):
        low[on] = high[on] + 1
        high[on] += step
        step *= 2
        on = on[high[on] < limit[on]]
        on = on[longer[high[on]] < ends[on]]
    high = np.minimum(high, limit)
    on = np.flatnonzero(low < high)
    while len(on):
        mid = (low[on] + high[on]) >> 1
        less = longer[mid] < ends[on]
        low[on[less]], high[on[~less]] = mid[less] + 1, mid[~less]
        on = on[low[on] < high[on]]
    found = low < limit
    found &= longer[np.minimum(low, last)] == ends
    return np.where(found, low, -1)


def common_ends(a: np.ndarray, b: np.ndarray, until_a: np.ndarray, until_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of their common ends, stretch by stretch.

    Stretch k has the places until[k] to until[k + 1] of either list. Its
    shorter list drives the search through the longer one.
    """
    n_a, n_b = np.diff(until_a), np.diff(until_b)
    a_drives = n_a <= n_b
    out = []
    for here, there, n, low, limit, drives in ((a, b, n_a, until_b[:-1], until_b[1:], a_drives), (b, a, n_b, until_a[:-1], until_a[1:], ~a_drives)):
        mine = np.flatnonzero(np.repeat(drives, n))
        of = np.repeat(np.arange(len(n)), n)[mine]
        place = gallop(here[mine], there, low[of], limit[of])
        out.append((mine[place >= 0], place[place >= 0]))
    x, y = np.concatenate([out[0][0], out[1][1]]), np.concatenate([out[0][1], out[1][0]])
    order = np.argsort(x)
    return x[order], y[order]


def overlaps(a: list[int], b: list[int], cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each token of ``a`` the first and last place in ``b`` whose bytes it shares.

    Inside a group the places of ``b`` are counted on from the group's first:
    a token's last partner is the first that does not end before it, and the
    next token starts with that one or, if it ended there, with the one after.
    """
    out, i, j = [], 0, 0
    for last_a, last_b in cuts:
        while i <= last_a:
            first = j
            while j < last_b and b[j] < a[i]:
                j += 1
            out.append((first, j))
            j += b[j] == a[i]
            i += 1
    return out


# --- the two tokenizers


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers, their tokens' bytes, and the stretches seen so far."""

    def __init__(self, folder: str, a_file: str, b_file: str):
        import json
        import os

        # Each task is one thread: threads of their own would compete for the cores of all tasks and hold memory each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{a_file}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{b_file}")
        chars = _byte_chars()
        self.a_bytes = {i: bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        before = json.loads(self.a.to_str())
        pre = before.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
                     and before.get("normalizer") is None and not any(re.search("[^▁]▁", p) for p in pieces))
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_size[i] = len(t)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.n_a, self.n_b, self.good, self.groups = array("q"), array("q"), array("b"), []
        self.links, self.until = array("q"), array("q", [0])  # links of stretch k: until[k] to until[k + 1]

    def stretches(self, text: str) -> list[str]:
        """``text``, with a space before it, cut where both tokenizers must cut; the space that begins each is left out."""
        if not self.cuts:
            return [text]
        if text[0] == " " or _JOINED.search(text):
            return [s[1:] for s in _CUT.split(" " + text)]
        return text.split(" ")

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each stretch as they are inside a text."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)]
        b = self.b.encode(stretches, num_threads=1)
        for i, s in enumerate(stretches):
            if not s:  # nothing after the space: encoded behind a letter, which is left out again
                b[i] = self.b.encode("a ")[len(self.b.encode("a")):]
        return a, b

    def aligned(self, stretches: list[str]) -> tuple:
        """Ids of both kinds with the stretches' bounds, places of the common ends, and which stretches keep their bytes.

        A stretch whose tokens' bytes are not its own has no tokens here.
        """
        a, b = self.encode(stretches)
        good = np.ones(len(stretches), bool)
        for table, side in ((self.a_bytes, a), (self.b_bytes, b)):
            if b"".join([table[i] for ids in side for i in ids]) != (" " + " ".join(stretches)).encode():
                good &= [b"".join([table[i] for i in ids]) == (" " + s).encode() for ids, s in zip(side, stretches)]
        if not good.all():
            a, b = ([ids if ok else [] for ids, ok in zip(side, good)] for side in (a, b))
        flat_a, flat_b = (np.fromiter((i for ids in side for i in ids), np.int64) for side in (a, b))
        until_a, until_b = (np.cumsum([0, *map(len, side)]) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        return flat_a, flat_b, until_a, until_b, ends_a, ends_b, *common_ends(ends_a, ends_b, until_a, until_b), good

    def learn(self, stretches: list[str]) -> None:
        """Encode and align what has not been seen."""
        new = [s for s in dict.fromkeys(stretches) if s not in self.place]
        for start in range(0, len(new), _AT_ONCE):
            some = new[start:start + _AT_ONCE]
            a, b, until_a, until_b, _, _, x, y, good = self.aligned(some)
            self.place.update(zip(some, range(len(self.n_a), len(self.n_a) + len(some))))
            self.n_a.frombytes(np.diff(until_a).astype(np.int64).tobytes())
            self.n_b.frombytes(np.diff(until_b).astype(np.int64).tobytes())
            self.good.frombytes(good.astype(np.int8).tobytes())
            self.links.frombytes((a[x] << 32 | b[y]).tobytes())
            cuts = np.searchsorted(x, until_a)
            self.until.frombytes((self.until[-1] + cuts[1:]).astype(np.int64).tobytes())
            # The groups as text: each goes from the place after the cut before it.
            ids_a, ids_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            parts = [f"{ids_a[i]}|{ids_b[j]}" if i == p and j == q else ",".join(ids_a[i:p + 1]) + "|" + ",".join(ids_b[j:q + 1])
                     for i, p, j, q in zip([0, *(x + 1).tolist()], x.tolist(), [0, *(y + 1).tolist()], y.tolist())]
            cuts = cuts.tolist()
            self.groups += [";".join(parts[i:j]) for i, j in zip(cuts, cuts[1:])]


# --- blocks of documents


def _block(name: int, ids: pa.Array, texts: list[str], pair: Pair) -> pa.RecordBatch:
    """One row: the documents' figures, and their links as places in the block's distinct pairs."""
    cut = [pair.stretches(t) if t else [] for t in texts]
    if len(pair.place) > MAX_STRETCHES:
        pair.clear()
    pair.learn([s for c in cut for s in c])
    n_a, n_b, until, known = (np.array(x, np.int64) for x in (pair.n_a, pair.n_b, pair.until, pair.links))
    good, sizes = np.array(pair.good, bool), np.diff(until)
    figures, hashes, links = np.zeros((3, len(texts)), np.int64), [], [np.zeros(0, np.int64)]
    for k, c in enumerate(cut):
        known_at = list(map(pair.place.__getitem__, c))
        at = np.array(known_at, np.int64)
        if not c or not good[at].all():
            hashes.append("")
            continue
        n = sizes[at]
        figures[:, k] = n_a[at].sum(), n_b[at].sum(), n.sum()
        hashes.append(hashlib.sha256(";".join(map(pair.groups.__getitem__, known_at)).encode()).hexdigest())
        links.append(known[np.arange(figures[2, k]) + np.repeat(until[at] - (np.cumsum(n) - n), n)])
    pairs, place, totals = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    # Per document its distinct links and how often it has each.
    doc = np.repeat(np.arange(len(texts)), figures[2])
    held, n = np.unique(doc * max(len(pairs), 1) + place, return_counts=True)
    per_doc = np.bincount(held // max(len(pairs), 1), minlength=len(texts))
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays(
        [pa.array([name], pa.int64()), one(ids), *(one(pa.array(f)) for f in figures), one(pa.array(hashes, pa.string())),
         one(pa.array(pairs)), one(pa.array(totals.astype(np.int64))), one(pa.array(per_doc.astype(np.int32))),
         one(pa.array((held % max(len(pairs), 1)).astype(np.int32))), one(pa.array(n.astype(np.int32)))],
        names=["block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "totals", "held", "place", "n"])


def _encoded(folder: str, a_file: str, b_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, name = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            pair = pair or Pair(folder, a_file, b_file)
            start, chars, texts = 0, 0, []
            for i in range(len(batch)):
                texts.append(batch.column("text")[i].as_py())
                chars += len(texts[-1])
                if chars >= BLOCK_CHARS or i == len(batch) - 1:
                    yield _block(name, batch.column("doc_id")[start:i + 1], texts, pair)
                    name, start, chars, texts = name + 1, i + 1, 0, []

    return run


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the blocks, with the counts of their links."""
    for batch in batches:
        for r in range(len(batch)):
            col = {name: batch.column(i)[r].values for i, name in enumerate(batch.schema.names) if name != "block"}
            figures = {k: (v.to_numpy(zero_copy_only=False) if v is not None else np.zeros(0, np.int64))
                       for k, v in col.items() if k in ("held", "place", "n", "at", "count", "best")}
            order = np.argsort(figures["at"])
            count, best = figures["count"][order].astype(np.int64), figures["best"][order].astype(np.int64)
            doc = np.repeat(np.arange(len(figures["held"])), figures["held"])
            place, n = figures["place"], figures["n"].astype(np.int64)
            sums = np.zeros((2, len(figures["held"])), np.int64)
            if len(doc):
                np.add.at(sums[0], doc, n * best[place])
                np.add.at(sums[1], doc, n * count[place])
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"], col["n_a"], col["n_b"], col["n_groups"], col["n_groups"], pa.array(sums[0]), pa.array(sums[1]), col["groups_sha256"]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: tokens of both kinds, groups, links, how its links stand in the whole corpus, and a hash of the groups."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    longs = ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups"))
    blocks = materialise(rows.mapInArrow(_encoded(folder, a_file, b_file), (
        f"block long, doc_id array<{kind}>, {longs}, groups_sha256 array<string>, pairs array<long>, totals array<long>, "
        "held array<int>, place array<int>, n array<int>")), "token-blocks")
    counts = pair_counts(blocks)
    by_block = blocks.select("block", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair").groupBy("block").agg(
        F.collect_list(F.struct("at", "count", "best")).alias("c"))
    looked_up = blocks.drop("pairs", "totals").join(by_block, "block", "left").select(
        *(c for c in blocks.columns if c not in ("pairs", "totals")),
        *(F.coalesce(F.col(f"c.{f}"), F.array().cast(f"array<{t}>")).alias(f) for f, t in (("at", "int"), ("count", "long"), ("best", "boolean"))))
    return looked_up.mapInArrow(_scored, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id << 32 | B id), its links in the corpus, and whether no other pair of its B id has more."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.totals").alias("count"))
    # A B id's pairs are at most as many as the A vocabulary.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


# --- the groups themselves


def _listed(folder: str, a_file: str, b_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for batch in batches:
            pair = pair or Pair(folder, a_file, b_file)
            rows: dict[str, list] = {k: [] for k in ("doc_id", "group", "start", "end", "a_ids", "b_ids", "a_overlaps")}
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for row in token_groups(pair, t):
                    for k, v in zip(rows, (doc, *row)):
                        rows[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], batch.schema.field("doc_id").type), *(pa.array(rows[k], pa.int64()) for k in ("group", "start", "end")),
                 *(pa.array(rows[k], pa.list_(pa.int32())) for k in ("a_ids", "b_ids")),
                 pa.array(rows["a_overlaps"], pa.list_(pa.list_(pa.int32())))], names=list(rows))

    return run


def token_groups(pair: Pair, text: str) -> list[tuple]:
    """(group, first byte, end byte, A ids, B ids, per A id its first and last partner in the group) of space + text."""
    if not text:
        return []
    a, b, until_a, until_b, a_ends, b_ends, x, y, good = pair.aligned(pair.stretches(text))
    if not good.all():
        return []
    a, b, a_ends, b_ends, cuts = a.tolist(), b.tolist(), a_ends.tolist(), b_ends.tolist(), list(zip(x.tolist(), y.tolist()))
    shared = overlaps(a_ends, b_ends, cuts)
    out, i, j, start = [], 0, 0, 0
    for g, (p, q) in enumerate(cuts):
        out.append((g, start, a_ends[p], a[i:p + 1], b[j:q + 1], [[u - j, v - j] for u, v in shared[i:p + 1]]))
        i, j, start = p + 1, q + 1, a_ends[p]
    return out


def groups(docs: DataFrame, folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per group of each document: its bytes in space + text, the ids of both kinds, and which overlap."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_listed(folder, a_file, b_file), (
        f"doc_id {kind}, group long, start long, end long, a_ids array<int>, b_ids array<int>, a_overlaps array<array<int>>"))
