"""Byte repeats, vector codes and token alignment against brute force, and their defined results on edge cases."""

import hashlib
import random
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import LONG, SF, edge_rows, table
from tidewatch.llm import crosstok, queries, suffixdedup, vectorcodes


# --- repeated byte strings


def brute_repeats(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(e[p:p + length] for _, e in texts for p in range(len(e) - length + 1))
    out = []
    for i, e in texts:
        edge = np.zeros(len(e) + 1, np.int64)
        for p in range(len(e) - length + 1):
            if seen[e[p:p + length]] > 1:
                edge[p] += 1
                edge[p + length] -= 1
        gone = np.cumsum(edge)[:len(e)] > 0
        kept = np.frombuffer(e, np.uint8)[~gone].tobytes()
        out.append((i, len(e), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_ranks():
    rng = random.Random(3)
    for n in [*range(12), 50, 51, 52, 400]:
        for kinds in (1, 2, 40):
            s = [rng.randint(1, kinds) for _ in range(n)]
            ranks = suffixdedup._ranks(np.array(s, np.int64)).tolist()
            assert sorted(range(n), key=lambda i: s[i:]) == [ranks.index(r) for r in range(n)]


def shared_passages():
    """Texts that share passages of about the length, at odd places, with different edges."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdeé漢🙂", k=rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60), prose(25), prose(31)]
    rows = [(100 + i, prose(rng.randint(0, 40)) + " " + rng.choice(passages)[rng.randint(0, 30):] + " " + prose(rng.randint(0, 30)) + rng.choice(passages))
            for i in range(60)]
    base = prose(300)
    for i in range(30):  # near copies
        at = rng.randint(0, len(base) - 5)
        rows.append((300 + i, base[:at] + word() + base[at + 3:]))
    return rows + [(400, "ab" * 500), (401, "x" + "ab" * 300), (402, "a" * 700), (403, "q" * 199), (404, "q" * 200), (405, "q" * 201)]


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats_match_brute_force(spark, group):
    rows = [(i, t) for i, t, _ in edge_rows()] + shared_passages()
    got = suffixdedup.dedup(table(spark, [(i, t, "s") for i, t in rows]).repartition(5), digest=True, group=group).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)


def test_repeats_of_another_length_and_the_bytes_that_stay(spark):
    rows = shared_passages()
    got = suffixdedup.dedup(table(spark, [(i, t, "s") for i, t in rows]), length=90).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str) == brute_repeats(rows, 90)


def test_repeats_in_pieces(spark, monkeypatch):
    """A text longer than a piece, that repeats a passage over a piece's edge."""
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh ", k=3 * suffixdedup.PIECE + 77))
    edge = suffixdedup.PIECE - 150
    rows = [(1, long), (2, "z" + long[edge:edge + 400] + "y"), (3, long[:199]), (4, long[-250:])]
    got = {r.doc_id: r for r in suffixdedup.dedup(table(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (650, 2) and bytes(got[2].kept) == b"zy"
    assert got[3].n_removed == 0 and got[4].n_removed == 250


def rows_written(monkeypatch):
    """Rows that the operator writes, by the name of the table."""
    rows, plain = Counter(), suffixdedup.materialise

    def counting(df, name="stage", counted=False):
        stored, n = plain(df, name, counted=True)
        rows[name] += n
        return (stored, n) if counted else stored

    monkeypatch.setattr(suffixdedup, "materialise", counting)
    return rows


def test_copies_of_a_text_bring_its_passages_and_windows_once(spark, monkeypatch):
    """Copies in one batch and in several; near copies keep their passages in the sort."""
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    base = " ".join(words)
    rows = [(i, base) for i in range(60)] + [(100 + i, " ".join(w if rng.random() > 0.03 else "new" for w in words)) for i in range(6)]

    def windows(length, kind):
        def run(batches):
            for batch in batches:
                n = pa.array([len(w) if w.is_valid else 0 for w in batch.column("w")], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, n, n, pa.array([""] * len(n))],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        return run

    written = rows_written(monkeypatch)
    docs = lambda parts: table(spark, [(i, t, "s") for i, t in rows]).repartition(parts)
    for parts in (1, 7):
        assert sorted(map(tuple, suffixdedup.dedup(docs(parts), digest=True, group=2).collect()), key=str) == brute_repeats(rows)
    assert written["passages"] < 2 * 7 * len(base) / 10
    with monkeypatch.context() as m:
        m.setattr(suffixdedup, "_cut", windows)
        most = max(r.n_spans for r in suffixdedup.dedup(docs(7), digest=True).collect())
    assert most < len(base) / 10


def test_passages_with_a_long_part_in_common_are_halved_without_a_row_for_each_window(spark, monkeypatch):
    rng = random.Random(22)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))
    line = prose(60)
    rows = [(i, f"{prose(40)} {line} {prose(40)}") for i in range(50)]
    written = rows_written(monkeypatch)
    got = suffixdedup.dedup(table(spark, [(i, t, "s") for i, t in rows]), digest=True, group=20).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)
    assert 0 < written["core-halves"] < 30 * len(rows)


def test_suffixdedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op11_suffixdedup(spark, SF).collect()), key=str) == brute_repeats(rows)


# --- vector codes


def brute_codes(rows, rounds=4, entries=256):
    """rows of (id, vector, label) in order of id; plain arithmetic."""
    kept = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in v], c) for i, v, c in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return [], ""
    width = -(-max(len(v) for _, v, _ in kept) // 4) * 4
    m = width // 4
    vecs = [v + [0] * (width - len(v)) for _, v, _ in kept]
    parts = [[v[p * m:(p + 1) * m] for v in vecs] for p in range(4)]
    books = [part[:entries] for part in parts]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        new = []
        for part, book in zip(parts, books):
            of = defaultdict(list)
            for x in part:
                of[near(x, book)[1]].append(x)
            new.append([[sum(c) // len(of[j]) for c in zip(*of[j])] if j in of else e for j, e in enumerate(book)])
        books = new
    found = [[near(x, book) for x in part] for part, book in zip(parts, books)]
    error = [sum(found[p][k][0] for p in range(4)) for k in range(len(kept))]
    by = Counter()
    for (_, _, c), e in zip(kept, error):
        by[c] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{found[p][k][1]:02x}" for p in range(4)), error[k], by[c]) for k, (i, _, c) in enumerate(kept)], digest


VECTORS = "vec_id long, embedding array<float>, label int, q int, part string, error string, _label string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "p", "e", "l") for i, v, c in rows], VECTORS)


def coded(spark, rows, **kw):
    c = vectorcodes.encode(vectors(spark, rows), **kw)
    out = vectorcodes.with_label_errors(c).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, out), key=str), c.books_sha256()


def test_codes_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(10)], rng.choice([None, 1, 2])) for i in range(330)]
    rows += [(400 + i, [0.25] * 10, 7) for i in range(40)]  # a common vector
    want, digest = brute_codes(rows)
    for bits in (3, 6, 20):  # many cells, few, one
        assert coded(spark, rows, cell_bits=bits) == (sorted(want, key=str), digest)


def test_codes_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 0.125, 1.0, 2.0, 0.0], 1), (2, None, 1), (3, [0.1, None, 0.2], 1), (4, [nan, 1.0], 1), (5, [1.0, inf], 1),
            (6, [], None), (7, [-0.001], None), (8, [0.5, -0.25, 0.125, 1.0, 2.0, 0.0], 1), (8, [0.5, -0.25, 0.125, 1.0, 2.0, 0.0], 1)]
    want, digest = brute_codes(rows)
    assert coded(spark, rows) == (sorted(want, key=str), digest)
    assert coded(spark, rows[1:5]) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, [(1, [], 1)])[0] == [(1, "00000000", 0, 0)]
    big = coded(spark, [(1, [3e38, -3e38, 0.0, 0.0], 1), (None, [0.0] * 4, 1)])[0]
    assert len(big) == 2 and all(r[2] >= 0 for r in big)


def test_cells_reuse_and_skip():
    rng = np.random.default_rng(4)
    book = rng.integers(-300, 300, (256, 4))
    cells = vectorcodes.Cells(book, 6)
    for _ in range(2):
        x = rng.integers(-300, 300, (500, 4))
        entry, dist = cells.nearest(x)
        d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (entry == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
        cells.nearest(x)
    assert cells.reused > 500 and cells.evaluated < 2000 * 256 / 3
    small = vectorcodes.Cells(book, 6, max_cells=10)  # the memory is emptied, results stay
    assert (small.nearest(x)[0] == entry).all() and (small.nearest(x)[0] == entry).all()


# --- token alignment


def brute_alignment(rows, folder=crosstok.TOKENIZERS):
    """Whole texts through both libraries, byte ends in sets."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{folder}/{crosstok.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{crosstok.B_FILE}")
    chars = crosstok._byte_chars()

    def side_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for _, t in rows:
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [side_b(i) for i in ids_b]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            found.append((0, 0, "", []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (bytes_a, bytes_b))
        at_b = {e: j for j, e in enumerate(ends_b)}
        cuts = [(i, at_b[e]) for i, e in enumerate(ends_a) if e in at_b]
        links = [(ids_a[i], ids_b[j]) for i, j in cuts]
        counts.update(links)
        text, i, j = [], 0, 0
        for x, y in cuts:
            text.append(",".join(map(str, ids_a[i:x + 1])) + "|" + ",".join(map(str, ids_b[j:y + 1])))
            i, j = x + 1, y + 1
        found.append((len(ids_a), len(ids_b), hashlib.sha256(";".join(text).encode()).hexdigest(), links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i, na, nb, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), h)
                   for (i, _), (na, nb, h, links) in zip(rows, found)), key=str)


def odd_texts():
    texts = [" ", "  ", "a ", " a", "a  b", "a   b  ", "\n", "a\n b", "a \n b", "tab\t x", "  x y", "x  y", "<|endoftext|> <s> </s> <0x41> <unk>",
             "▁ under", "x▁y ▁", "é é ﬁ ½", "漢字 かな 🙂👍🏽 ", "it's we'll 'S don't ", "1234567 12,345.6", "\x00 a\x1c b\x85 c", "A" * 3000, "word " * 2000, "$$$ %%% ###",
             "def f(x):\n    return x + 1\n\n\n", "\r\n\r\n x", "﻿ bom", "שלום עולם", "x ​ y"]
    rng = random.Random(8)
    texts += ["".join(rng.choices("ab '\n\t., é漢🙂▁<s>0", k=rng.randint(1, 60))) for _ in range(150)]
    return [(1000 + i, t) for i, t in enumerate(texts)]


def test_alignment_matches_brute_force(spark, monkeypatch):
    rows = [(i, t) for i, t, _ in edge_rows() if t != LONG] + odd_texts()
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = crosstok.align(table(spark, [(i, t, "s") for i, t in rows]).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows)


def test_alignment_in_small_blocks_and_without_cuts(monkeypatch):
    """Stretches and whole texts give the same tokens; so does an emptied memory."""
    pair = crosstok.Pair(crosstok.TOKENIZERS, crosstok.A_FILE, crosstok.B_FILE)
    whole = crosstok.Pair(crosstok.TOKENIZERS, crosstok.A_FILE, crosstok.B_FILE)
    assert pair.cuts
    whole.cuts = False
    for _, t in odd_texts():
        flat = lambda p: [[i for x in side for i in x] for side in p.encode(p.stretches(t))]
        assert flat(pair) == flat(whole) == [whole.a.encode(" " + t).ids, whole.b.encode(t)]
        assert crosstok.token_groups(pair, t) == crosstok.token_groups(whole, t)


def test_galloping_and_overlaps():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randint(1, 60)
        a, b = (sorted(rng.sample(range(1, n + 1), rng.randint(0, n - 1) if n > 1 else 0) + [n + 1]) for _ in "ab")
        # Between an empty stretch and one of a single common end.
        bounds = [np.array([0, 0, len(s), len(s) + 1]) for s in (a, b)]
        x, y = crosstok.common_ends(np.array([*a, n + 2]), np.array([*b, n + 2]), *bounds)
        assert (x[-1], y[-1]) == (len(a), len(b))
        cuts = list(zip(x[:-1].tolist(), y[:-1].tolist()))
        assert cuts == [(i, b.index(e)) for i, e in enumerate(a) if e in b]
        starts_a, starts_b = [0, *a], [0, *b]
        want = []
        for i, e in enumerate(a):
            met = [j for j, f in enumerate(b) if starts_b[j] < e and f > starts_a[i]]
            want.append((met[0], met[-1]))
        assert crosstok.overlaps(a, b, cuts) == want


def test_groups_of_tokens(spark):
    rows = crosstok.groups(table(spark, [(1, "unbelievable 漢字", "s"), (2, None, "s"), (3, "", "s")])).orderBy("doc_id", "group").collect()
    assert {r.doc_id for r in rows} == {1} and rows[0].start == 0 and rows[-1].end == len(" unbelievable 漢字".encode())
    assert all(r.start == p.end for p, r in zip(rows, rows[1:])) and all(len(r.a_overlaps) == len(r.a_ids) for r in rows)


def test_empty_tables(spark):
    docs = table(spark, []).limit(0)
    assert suffixdedup.dedup(docs).count() == 0 and crosstok.align(docs).count() == 0 and crosstok.groups(docs).count() == 0
    none = vectorcodes.encode(vectors(spark, []).limit(0))
    assert none.rows.count() == 0 and vectorcodes.with_label_errors(none).count() == 0


def test_extra_columns_with_internal_names(spark):
    docs = table(spark, [(1, "a b c " * 60, "s"), (2, "a b c " * 60, "s")])
    for c in ("key", "bytes", "w", "first", "last", "core", "block", "pairs"):
        docs = docs.withColumn(c, F.lit("theirs"))
    assert [r.n_removed for r in suffixdedup.dedup(docs).collect()] == [360, 360]
    assert {r.n_groups for r in crosstok.align(docs).collect()} == {181}
