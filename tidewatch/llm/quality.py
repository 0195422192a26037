"""Learned decision lists over text statistics (quality rules).

``statistics`` adds per-document counts in one pass over the whole text.
``learn`` fits an ordered list of threshold conjunctions by sequential
covering: each rule is grown condition by condition on two thirds of a bounded
labelled sample (FOIL gain), pruned back on the other third, and kept while it
is precise there; the documents it covers leave the sample and the next rule
is grown. ``rule_column`` turns the list into one ordered Spark conditional
expression (the number of the first rule that holds, null if none does).

Defined results: a null or empty text has no words and fails the base rules; a
document without label takes part in scoring only; without labels of both
classes the list is empty; repeated rows are judged alike; further columns of
the input are carried along and never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WS, let, text_of, words_of
from tidewatch.operators.joins import materialise

# The labelled sample that the list is fitted on: a documented bound.
MAX_TRAIN_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 3
N_CUTS = 24
MIN_PRECISION = 0.97
MIN_COVER = 8

_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars_all",
          "n_upper", "n_digits", "n_distinct", "n_pipes", "n_marks", "longest_word"]
FEATURES = ["f_words", "f_word_len", "f_symbols", "f_dup_lines", "f_repeat", "f_upper", "f_digits",
            "f_distinct", "f_pipes", "f_marks", "f_longest", "f_line_words"]


def _repeat_words(windows: Column) -> Column:
    """Words inside 5-word windows that occur at least twice; ``windows`` holds their hashes."""
    def covered(order: Column) -> Column:
        twice = F.filter(order, lambda x, i: (
            (F.get(order, i - 1)["h"] == x["h"]) & (i > 0)) | F.coalesce(F.get(order, i + 1)["h"] == x["h"], F.lit(False)))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-10).alias("end")),
            lambda s, p: F.struct((s["n"] + p + 5 - F.greatest(p, s["end"])).cast("int").alias("n"),
                                  (p + 5).cast("int").alias("end")),
            lambda s: s["n"])

    tagged = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(tagged, covered))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``_q`` of counts and ratios."""
    t = docs.withColumn("_q_text", text_of(text))
    t = t.withColumn("_q_words", words_of(F.col("_q_text")))
    t = t.withColumn("_q_lines", F.filter(F.split("_q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = t.withColumn("_q_hash", F.transform("_q_words", lambda w: F.xxhash64(w)))
    t = t.withColumn("_q_win", F.when(F.size("_q_hash") >= 10, F.transform(
        F.slice("_q_hash", F.lit(1), F.size("_q_hash") - 4),
        lambda h, i: F.xxhash64(h, *(F.get("_q_hash", i + k) for k in range(1, 5))))).otherwise(
        F.when(F.size("_q_hash") >= 5, F.transform(
            F.sequence(F.lit(0), F.size("_q_hash") - 5),
            lambda i: F.xxhash64(*(F.get("_q_hash", i + k) for k in range(5)))))
        .otherwise(F.array().cast("array<bigint>"))))

    def count(pattern: str) -> Column:
        return F.regexp_count("_q_text", F.lit(pattern)).cast("long")

    counts = F.struct(
        F.size("_q_words").cast("long").alias("n_words"),
        (F.length("_q_text") - count(WS)).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_q_win")).cast("long").alias("n_repeat_words"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        F.length("_q_text").cast("long").alias("n_chars_all"),
        count(r"\p{Lu}").alias("n_upper"),
        count("[0-9]").alias("n_digits"),
        F.size(F.array_distinct("_q_hash")).cast("long").alias("n_distinct"),
        count(r"\|").alias("n_pipes"),
        count("[!?;:]").alias("n_marks"),
        F.coalesce(F.array_max(F.transform("_q_words", lambda w: F.length(w))), F.lit(0)).cast("long").alias("longest_word"),
    )
    out = t.withColumn("_q", counts).drop("_q_text", "_q_words", "_q_lines", "_q_hash", "_q_win")
    q = {c: F.col("_q")[c].cast("double") for c in _STATS}

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    ratios = {
        "f_words": q["n_words"], "f_word_len": share(q["word_chars"], q["n_words"]),
        "f_symbols": share(q["n_symbols"], q["word_chars"]), "f_dup_lines": share(q["n_dup_lines"], q["n_lines"]),
        "f_repeat": share(q["n_repeat_words"], q["n_words"]), "f_upper": share(q["n_upper"], q["word_chars"]),
        "f_digits": share(q["n_digits"], q["word_chars"]), "f_distinct": share(q["n_distinct"], q["n_words"]),
        "f_pipes": share(q["n_pipes"], q["n_words"]), "f_marks": share(q["n_marks"], q["n_words"]),
        "f_longest": q["longest_word"], "f_line_words": share(q["n_words"], q["n_lines"]),
    }
    return out.withColumn("_q", F.struct("_q.*", *(ratios[f].alias(f) for f in FEATURES)))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self, of) -> Column:
        return of(self.feature) > self.cut if self.above else of(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, of) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(of)
    return out


def _gain(p0: float, n0: float, p1: float, n1: float) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 and p0 else 0.0


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", text: str = "text") -> list[Rule]:
    """Fit the list on documents whose ``label`` is 0 (bad) or 1 (good).

    Only the documents of the labelled sample (at most ``MAX_TRAIN_ROWS``
    labels, in hash order) are counted: they are picked before their statistics.
    """
    sample = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
              .where("_id is not null and _y in (0, 1)")
              .groupBy("_id").agg(F.min("_y").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(MAX_TRAIN_ROWS))
    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    # Written first, so that statistics are computed for the sample only and by several tasks.
    rows = statistics(materialise(picked, "quality-picked"), "_text").select("_id", "_y", *(F.col("_q")[f].alias(f) for f in FEATURES))
    table = materialise(rows.withColumn("_prune", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(3)) == 0), "quality-sample")
    # The sample is bounded, so one task holds it.
    table = table.coalesce(1)
    cuts_row = table.agg(*(F.percentile_approx(f, [i / (N_CUTS + 1) for i in range(1, N_CUTS + 1)], 2000).alias(f)
                           for f in FEATURES), F.count_if(F.col("_y") == 0).alias("bad"),
                         F.count_if(F.col("_y") == 1).alias("good")).first()
    if not cuts_row["bad"] or not cuts_row["good"]:
        return []
    # Quantiles of the bad documents too: junk may be rare in the sample.
    bad_row = table.where("_y = 0").agg(*(F.percentile_approx(
        f, [i / (N_CUTS + 1) for i in range(1, N_CUTS + 1)], 2000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted({float(x) for r in (cuts_row, bad_row) for x in (r[f] or [])}) for f in FEATURES}

    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = table
        for r in rules:
            left = left.where(~_holds(r, F.col))
        rule = _grow(left.where(~F.col("_prune")), cuts)
        rule = _prune(left, rule)
        if not rule:
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        # One histogram job: bad and good documents per feature and bin.
        binned = F.array(*(F.struct(F.lit(k).alias("f"), sum(
            ((F.col(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias("b")) for k, f in enumerate(FEATURES)))
        found = (rows.where(_holds(rule, F.col)).select("_y", F.explode(binned).alias("x"))
                 .groupBy("x.f", "x.b").agg(F.count_if(F.col("_y") == 0).alias("p"),
                                            F.count_if(F.col("_y") == 1).alias("n")).collect())
        p0 = sum(r["p"] for r in found if r["f"] == 0)
        n0 = sum(r["n"] for r in found if r["f"] == 0)
        if not p0 or not n0:
            break
        best: tuple[float, Condition | None] = (1e-9, None)
        for k, f in enumerate(FEATURES):
            at = {r["b"]: (r["p"], r["n"]) for r in found if r["f"] == k}
            p_low = n_low = 0
            for b, cut in enumerate(cuts[f]):
                p_low += at.get(b, (0, 0))[0]
                n_low += at.get(b, (0, 0))[1]
                for above, p1, n1 in ((True, p0 - p_low, n0 - n_low), (False, p_low, n_low)):
                    if p1 >= MIN_COVER and (g := _gain(p0, n0, p1, n1)) > best[0]:
                        best = (g, Condition(f, above, cut))
        if best[1] is None:
            break
        rule += (best[1],)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of ``rule`` that is best on the pruning third, if precise enough."""
    if not rule:
        return ()
    sums = []
    for k in range(1, len(rule) + 1):
        for y, name in ((0, "p"), (1, "n")):
            held = _holds(rule[:k], F.col) & (F.col("_y") == y)
            sums += [F.count_if(held & F.col("_prune")).alias(f"{name}{k}"), F.count_if(held).alias(f"all_{name}{k}")]
    r = rows.agg(*sums).first()

    def worth(k: int) -> tuple[float, int]:
        p, n = r[f"p{k}"], r[f"n{k}"]
        return ((p - n) / (p + n) if p + n else -1.0, -k)

    best = max(range(1, len(rule) + 1), key=worth)
    p, n, ap, an = r[f"p{best}"], r[f"n{best}"], r[f"all_p{best}"], r[f"all_n{best}"]
    precise = ap >= MIN_COVER and ap >= MIN_PRECISION * (ap + an) and p >= MIN_PRECISION * (p + n) and p > 0
    return rule[:best] if precise else ()


def rule_column(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that holds for ``_q``; null if none does."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(_holds(rules[k - 1], lambda f: F.col("_q")[f]), F.lit(k)).otherwise(out)
    return out


def base_failed() -> Column:
    q = F.col("_q")
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``_q`` (statistics), ``_rule``, ``_base_failed`` and ``_kept``."""
    rules = learn(docs, labels, doc_id, text=text) if rules is None else rules
    return (statistics(docs, text).withColumn("_rule", rule_column(rules)).withColumn("_base_failed", base_failed())
            .withColumn("_kept", ~F.col("_base_failed") & F.col("_rule").isNull()))
