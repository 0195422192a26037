"""Chat formatting by quotation linking.

A line's quote level is the number of ``>`` marks it starts with. Neighbouring
lines of one level are a passage. Lines are normalised (marks off, white space
to one space, lower case) and passages are hashed in windows of 1, 2, 4, ...
lines, each hash made of two of the step before; the own lines of all messages
are hashed alike, as far as a quote shares them. Each window of a passage is
joined to the first message of the same conversation that says it. The
longest windows that an earlier message says decide: the original is the message
with most of them (ties: the earlier turn). So a message that says a whole
passage goes before an older one that says a line of it. A message replies to
the original of its first passage of level 1 that has one. Threads follow these
replies to their first message; conversations are given in thread order, then
turn order, so that each reply comes after what it answers. Passages that have
an original are cut, with the lines that announce them and the empty quoted
lines beside them; all other lines that begin with ``>`` are the message's own
(code, prompts, quotes from elsewhere) and stay.

A window has one row per place and one first message, so no line is paired with
all messages that say it. Everything is joined and counted by key; a
conversation is never gathered in one row or task. Threads are resolved by
pointer doubling.

Defined results: a null text is an empty message; a message without quotes, or
whose quotes no earlier message says, starts (or continues, as its own thread
of turn order) without a reply link; repeated rows (conv_id, turn) are one
position whose texts all count, and each row is returned; a null conv_id or
turn is never linked; very long texts cost time in proportion to their lines.
Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import let, mask_of, text_of
from tidewatch.operators.joins import materialise

# The marks at the start of a line, at most this many levels are told apart.
_MARKS = r"^(?:\x20?>)+\x20?"
_ANNOUNCES = r"(wrote|writes|schrieb|écrit|escribió)\s*:\s*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, n, level, passage, h): one row per line with a word, hashed."""
    out = messages.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.posexplode(F.split(text_of("text"), "\n")).alias("n", "line"))
    return out.select("conv_id", "turn", "n", _level(F.col("line")).alias("level"), _normal(F.col("line")).alias("norm")).where(
        "norm != ''").select("conv_id", "turn", "n", "level", F.xxhash64("norm").alias("h"))


_PASSAGE = ["conv_id", "turn", "level", "start"]


def _passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, start, pos, n, h): the quoted lines, numbered in passages that begin at line ``start``."""
    every = lines(messages.where(text_of("text").rlike(r"(?m)" + _MARKS))).distinct()
    # Number the passages of a message: a new one begins where the level changes.
    before = every.select("conv_id", "turn", (F.col("n") + 1).alias("n"), F.col("level").alias("prev")).distinct()
    marked = every.join(before, ["conv_id", "turn", "n"], "left")
    # A window holds the quoted lines of one message and level, so it is no larger than a row's text.
    upto = Window.partitionBy("conv_id", "turn", "level").orderBy("n").rangeBetween(Window.unboundedPreceding, 0)
    return marked.where("level > 0").withColumn(
        "start", F.max(F.when(F.col("prev").isNull() | (F.col("prev") != F.col("level")), F.col("n"))).over(upto)).select(
        *_PASSAGE, (F.col("n") - F.col("start")).alias("pos"), "n", "h").distinct()


def _doubled(windows: DataFrame, key: list[str], depth: int) -> DataFrame:
    """Windows of twice ``depth`` lines from those of ``depth`` lines."""
    ahead = windows.select(*key, (F.col("pos") - depth).alias("pos"), F.col("h").alias("next"))
    return windows.join(ahead, [*key, "pos"]).select(*key, "pos", F.xxhash64("h", "next").alias("h")).distinct()


def _linked(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The quoted lines, and each passage with its original."""
    passages = materialise(_passages(messages), "quote-passages")
    asked = passages.select(*_PASSAGE, "pos", "h")
    # Own lines that are quoted, numbered among the own lines of their message.
    wanted = asked.select("conv_id", "h").distinct()
    place = Window.partitionBy("conv_id", "turn").orderBy("n")
    quoted = messages.where("conv_id is not null").join(asked.select("conv_id").distinct(), "conv_id", "left_semi")
    own = (lines(quoted).where("level = 0").distinct().withColumn("pos", F.dense_rank().over(place))
           .join(wanted, ["conv_id", "h"], "left_semi").select("conv_id", "turn", "pos", "h"))
    said, depth, found = materialise(own, "quote-said"), 1, None
    while True:
        first = said.groupBy("conv_id", "h").agg(F.min("turn").alias("original"))
        votes, n = materialise(
            asked.join(first, ["conv_id", "h"]).where("original < turn").groupBy(*_PASSAGE, "original").agg(
                F.count(F.lit(1)).alias("shared")).withColumn("depth", F.lit(depth)), "quote-votes", counted=True)
        found = votes if found is None else found.unionByName(votes)
        if not n:
            break
        asked, n = materialise(_doubled(asked, _PASSAGE, depth), "quote-asked", counted=True)
        if not n:
            break
        said = materialise(_doubled(said, ["conv_id", "turn"], depth).join(
            asked.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi"), "quote-said")
        depth *= 2
    best = found.groupBy(*_PASSAGE).agg(F.max(F.struct("depth", "shared", (-F.col("original")).alias("o"))).alias("b"))
    # Lines of the passage that the original says in windows of the deciding length.
    return passages, best.select(*_PASSAGE, (-F.col("b.o")).alias("original"), (F.col("b.shared") + F.col("b.depth") - 1).alias("shared"))


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, n, level, original, shared): each quoted passage with its original.

    ``shared`` is the length of the passage's stretch that the original says,
    where its deciding windows follow each other.
    """
    return _linked(messages)[1].select("conv_id", "turn", F.col("start").alias("n"), "level", "original", "shared")


def _line_key(n: Column, h: Column) -> Column:
    return F.shiftleft(n.cast("long"), 32).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFFFF)))


def without_quotes(text: Column, cut: Column) -> Column:
    """The text less its linked quotes (``cut``: their line keys), lines that announce them and empty quoted lines beside them."""
    def kept(arr: Column) -> Column:
        keys = F.transform(arr, lambda x, i: _line_key(i, F.xxhash64(_normal(x))))
        gone = F.transform(F.array_intersect(keys, cut), lambda k: F.shiftright(k, 32).cast("int"))
        return let(F.when(F.size(gone) > 0, mask_of(gone)).otherwise(F.array(F.lit(0))), lambda m: F.filter(arr, lambda x, i: ~(
            _at(m, i) | (_at(m, i + 1) & x.rlike("(?i)" + _ANNOUNCES))
            | ((_at(m, i + 1) | _at(m, i - 1)) & (_level(x) > 0) & (_normal(x) == "")))))

    whole = let(F.split(text, "\n"), lambda arr: F.trim(F.array_join(kept(arr), "\n"), F.lit(" \n\t\r")))
    return F.when(cut.isNotNull(), whole).otherwise(text)


def _at(mask: Column, i: Column) -> Column:
    return (i >= 0) & (F.coalesce(F.get(mask, i), F.lit(0)) == 1)


def conversations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text, n_quotes, reply_to, thread, depth.

    Sorted by (conv_id, thread, turn) the rows are the reply-ordered
    conversations; ``thread`` is the turn of the thread's first message.
    """
    m = messages.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    passages, linked = _linked(m)
    found = materialise(linked, "quote-links").withColumnRenamed("start", "n")
    replies = found.where("level = 1").groupBy("conv_id", "turn").agg(F.min(F.struct("n", "original"))["original"].alias("reply_to"))
    quotes = found.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_quotes"))
    cut = (passages.join(found.select("conv_id", "turn", "level", F.col("n").alias("start")), _PASSAGE)
           .groupBy("conv_id", "turn").agg(F.collect_set(_line_key(F.col("n"), F.col("h"))).alias("cut")))
    quotes = quotes.join(cut, ["conv_id", "turn"])
    # Pointer doubling: every message with a link jumps twice as far each round.
    jump = materialise(replies.select("conv_id", "turn", F.col("reply_to").alias("to"), F.lit(1).cast("long").alias("depth"),
                                      F.lit(True).alias("moved")), "quote-threads")
    while jump.where("moved").limit(1).count():
        far = jump.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        jump = materialise(jump.join(far, ["conv_id", "to"], "left").select(
            "conv_id", "turn", F.coalesce("next", "to").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved")), "quote-threads")
    linked = replies.join(jump.select("conv_id", "turn", F.col("to").alias("thread"), "depth"), ["conv_id", "turn"])
    out = m.join(quotes, ["conv_id", "turn"], "left").join(linked, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", without_quotes(text_of("text"), F.col("cut")).alias("text"),
                      F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), "reply_to",
                      F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
