"""Line dedup: maximal repeated line runs from suffix ranks by prefix doubling.

A document is the sequence of its lines that hold a word (a line's id is the
hash of its content; lines without a word stay where they are and break no
run). Every line starts a suffix of that sequence. Prefix doubling names the
first 1, 2, 4, ... lines of each suffix: two suffixes get the same rank at
depth d exactly if their first d lines agree, so the suffixes of one rank are
an interval of the suffix array whose longest common prefix is at least d.
Ranks are content hashes of (rank, rank d lines on), so no global sort is
needed to name them. After each step only suffixes whose rank is shared are
kept, and the doubling goes on for as long as any rank is.

In each interval the first suffix (by doc_id, then line) is the original and
all others are later copies. A later copy belongs to its deepest interval. Neighbouring
suffixes of a document whose originals are neighbours too are one maximal run:
it begins at the first of them and reaches over the prefix that the interval of
the last stands for. Where its lines have an earlier original from some line on,
a run ends and the next one begins; the lines of a run that shares more than its interval's depth are
those of the runs that follow it.
Intervals count from ``min_lines`` lines on; a line of at least ``line_words``
words is a run by itself, so its interval counts from depth one. The lines of
all runs go.

A rank that holds over a thousandth of all suffixes (there are less than a
thousand such) gets its original by broadcast; only the others are shuffled
by rank, so a very common line is no task of its own.

Defined results: a null or empty text has no lines and stays as it is; rows
that repeat a doc_id with the same text get the same result, and rows that
share a doc_id with different texts follow each other by text hash; a null
doc_id comes last. A row is never dropped, also when all its lines go. Very long texts
cost time in proportion to their lines. Input columns of any name are kept; only
``_n_lines`` and ``_n_deleted`` are replaced by the columns added here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, let, mask_of, prefix_sums, text_of
from tidewatch.operators.joins import materialise

MIN_LINES = 2
LINE_WORDS = 5  # a line of so many words, a word shingle, is a repeated run by itself
HOT_SHARE = 1000  # a rank of over one in so many suffixes is hot

_KEY = ["_d", "_h"]


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, _d, _h, text): a document is known by its id (null last) and the hash of its text."""
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("_d"),
                       F.xxhash64(text_of(text)).alias("_h"), F.col(text).cast("string").alias("text"))


def _shared(ranks: DataFrame, total: int) -> DataFrame:
    """The suffixes whose rank at least two of ``total`` suffixes have, with the first suffix of the rank."""
    first = materialise(ranks.groupBy("rank").agg(F.min(F.struct("_d", "_h", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "line-first")
    is_hot = F.col("n") * HOT_SHARE > total
    hot = F.broadcast(first.where(is_hot).drop("n"))  # less than HOT_SHARE rows
    rest = ranks.join(hot.select("rank"), "rank", "left_anti").join(first.where(~is_hot).drop("n"), "rank")
    return ranks.join(hot, "rank").unionByName(rest)


def _later(shared: DataFrame, depth: int) -> DataFrame:
    """The suffixes of an interval of ``depth`` but its first."""
    return shared.where(F.struct("_d", "_h", "pos") > F.col("first")).select(*_KEY, "pos", "first", F.lit(depth).alias("depth"))


def _is_long(line: Column, words: int) -> Column:
    """Has the line at least ``words`` words? Only lines of enough characters are counted."""
    return (F.length(line) >= 2 * words - 1) & (F.regexp_count(line, F.lit(WORD)) >= words)


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_lines: int = MIN_LINES, line_words: int = LINE_WORDS) -> DataFrame:
    """(_d, _h, pos, n, first): the ``n`` worded lines from ``pos`` on are a later copy of those from ``first`` on."""
    lines = _keyed(docs, doc_id, text).select(*_KEY, F.filter(F.split(text_of("text"), "\n"), _has_word).alias("l"))
    ranks = lines.select(*_KEY, F.posexplode("l").alias("pos", "line")).select(
        *_KEY, "pos", F.xxhash64("line").alias("rank"), _is_long(F.col("line"), line_words).alias("long"))
    # Repeated rows are one document here.
    ranks, total = materialise(ranks.dropDuplicates([*_KEY, "pos"]), "line-ranks", counted=True)
    shared, n = materialise(_shared(ranks, total), "line-shared", counted=True)
    depth = 1
    later = _later(shared if min_lines == 1 else shared.where("long"), 1)
    while n:
        step = depth if depth >= min_lines else min(depth, min_lines - depth)
        here = shared.select(*_KEY, "pos", "rank")
        ahead = here.select(*_KEY, (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        longer, total = materialise(here.join(ahead, [*_KEY, "pos"]).select(*_KEY, "pos", F.xxhash64("rank", "next").alias("rank")),
                                    "line-ranks", counted=True)
        depth += step
        shared, n = materialise(_shared(longer, total), "line-shared", counted=True)
        if depth >= min_lines:
            later = later.unionByName(_later(shared, depth))
    # The deepest interval of each later copy; what follows it in its document with the next original is its run.
    later = later.repartition(*_KEY).groupBy(*_KEY, "pos").agg(F.max(F.struct("depth", "first")).alias("b"))
    later = later.select(*_KEY, "pos", "b.depth", "b.first")
    lines_of = Window.partitionBy(*_KEY).orderBy("pos")
    before = F.lag(F.struct("pos", "first")).over(lines_of)
    follows = ((before["pos"] == F.col("pos") - 1) & (before["first"]["_d"] == F.col("first._d"))
               & (before["first"]["_h"] == F.col("first._h")) & (before["first"]["pos"] == F.col("first.pos") - 1))
    later = later.withColumn("start", F.when(F.coalesce(follows, F.lit(False)), F.lit(0)).otherwise(1))
    return (later.withColumn("run", F.sum("start").over(lines_of)).groupBy(*_KEY, "run")
            .agg(F.min("pos").alias("pos"), F.max(F.col("pos") + F.col("depth")).alias("end"), F.min("first").alias("first"))
            .select(*_KEY, "pos", (F.col("end") - F.col("pos")).alias("n"), "first"))


def _covered(runs: DataFrame) -> DataFrame:
    """(_d, _h, gone): the ascending numbers of the lines that runs cover; each run adds what those before it leave."""
    before = Window.partitionBy(*_KEY).orderBy("pos", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("n")
    fresh = runs.select(*_KEY, F.greatest("pos", F.coalesce(F.max(end).over(before), F.lit(0))).alias("low"), (end - 1).alias("high"))
    return fresh.where("low <= high").groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("r")).select(
        *_KEY, F.flatten(F.transform("r", lambda r: F.sequence(r["low"], r["high"]))).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                line_words: int = LINE_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``.

    Adds ``_n_lines`` (lines with a word) and ``_n_deleted``.
    """
    gone = _covered(repeated_runs(docs, doc_id, text, min_lines, line_words))
    out = _keyed(docs, doc_id, text).join(gone, _KEY, "left").withColumn("lines", F.split(text_of("text"), "\n"))
    n_lines = F.aggregate(F.transform("lines", lambda x: _has_word(x).cast("int")), F.lit(0), lambda a, x: a + x).cast("long")
    kept = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(_rebuilt(F.col("lines"), F.col("gone")))
    own = [(kept if c == text else F.col("row")[c]).alias(c) for c in docs.columns if c not in ("_n_lines", "_n_deleted")]
    return out.select(*own, n_lines.alias("_n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_n_deleted"))


def _rebuilt(lines: Column, gone: Column) -> Column:
    """The lines that stay, joined; ``gone`` are ascending numbers among the worded lines.

    One walk over the lines keeps how many worded lines and how many deleted
    ones have passed, so long texts cost linear time.
    """
    def walk(m: Column) -> Column:
        number = prefix_sums(F.transform(lines, lambda x: _has_word(x).cast("long")))
        return let(number, lambda num: F.array_join(F.filter(lines, lambda x, i: ~(
            _has_word(x) & (F.coalesce(F.get(m, F.get(num, i).cast("int") - 1), F.lit(0)) == 1))), "\n"))

    return let(mask_of(gone), walk)
