"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target of words: sources in code-point order (null last)
weigh 5, 2, 1, repeating, and share the budget (all words of the table); a
target above three times its source's words stops there and the excess is
shared anew by weight. Documents of a source stand in a shuffled (hash) order,
and up to three passes over it are queued. The virtual finish time of a copy
is the words its source has queued up to and with it, divided by the source's
target. All copies are ranked by finish time over all sources and the ranking
is cut where the budget is spent.

The order within a source and the global order are both found bucket by
bucket: bucket sums are added up over the (bounded) bucket table, and only
rows inside a bucket are sorted together, so neither a hot source nor the
whole table ever meets in one task.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own; repeated rows are queued as separate documents; an empty
table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, text_of
from tidewatch.operators.joins import materialise

# Fixed values of the contract: weights by source order, passes over a source.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
ROWS_PER_BUCKET = 4096
MAX_BUCKETS = 1 << 16


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source.

    The level L with sum(min(weight * L, 3 * source_size)) = budget is found in
    closed form: with sources by 3 * source_size / weight, L follows from the
    capped words before and the weight left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank - 1) % len(WEIGHTS) + 1))
    per = per.withColumn("cap", F.col("source_size") * MAX_PASSES)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(whole))
           .withColumn("cap_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
           .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))))
    level = (F.col("total") - F.coalesce("cap_before", F.lit(0))) / F.col("weight_left")
    # The first source whose cap lies above the level it would get sets the level (later ones give lower levels).
    per = per.withColumn("level", F.max(F.when(F.col("cap") > level * F.col("weight"), level)).over(whole))
    return per.select("source", "source_size", F.when(
        F.col("level").isNull() | (F.col("cap") <= F.col("level") * F.col("weight")), F.col("cap").cast("double"))
        .otherwise(F.col("level") * F.col("weight")).alias("target"))


def shuffle_key(doc_id: Column) -> Column:
    """Place in the shuffled order: the first 32 bits of a hash of the id."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken."""
    base = materialise(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        shuffle_key(F.col(doc_id)).alias("u")), "mix-sizes")
    n = base.count()
    buckets = max(1, min(MAX_BUCKETS, n // ROWS_PER_BUCKET))
    goal = materialise(targets(base), "mix-targets")

    # Words queued before each document in its source, bucket by bucket of the shuffled order.
    base = base.withColumn("b", F.floor(F.col("u") * F.lit(buckets) / F.lit(float(1 << 32))).cast("int"))
    sums = base.groupBy("source", "b").agg(F.sum("size").alias("s"))
    before = sums.withColumn("offset", F.coalesce(F.sum("s").over(
        Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("s")
    inner = Window.partitionBy("source", "b").orderBy("u", F.col("doc_id").asc_nulls_last(), "size")
    queued = base.withColumn("run", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    queued = (queued.alias("q").join(before.alias("o"), F.col("q.source").eqNullSafe(F.col("o.source"))
                                     & (F.col("q.b") == F.col("o.b")))
              .select("q.doc_id", "q.source", "q.size", "q.u", (F.col("run") + F.col("offset")).alias("cum")))
    queued = (queued.alias("q").join(goal.alias("g"), F.col("q.source").eqNullSafe(F.col("g.source")))
              .select("q.*", "g.source_size", "g.target"))
    queued = materialise(queued, "mix-queue")

    # Finish times of the copies; their global order is cut at the budget.
    def finish(e: int) -> Column:
        return F.when(F.col("target") > 0, (F.col("source_size") * e + F.col("cum")) / F.col("target"))

    copies = queued.where("size > 0").select("doc_id", "u", "size", F.explode(F.array(
        *(F.struct(F.lit(e).alias("e"), finish(e).alias("f")) for e in range(MAX_PASSES)))).alias("c"))
    copies = copies.select("doc_id", "u", "size", "c.e", "c.f").where("f is not null")
    # Finish times around 1 matter; far ones get logarithmic buckets, so there are few.
    fb = F.when(F.col("f") <= 4, F.floor(F.col("f") * buckets)).otherwise(
        F.floor((4 + F.log(F.col("f") / 4)) * buckets)).cast("long")
    copies = copies.withColumn("fb", fb)
    spent = copies.groupBy("fb").agg(F.sum("size").alias("s")).withColumn(
        "end", F.sum("s").over(Window.orderBy("fb").rowsBetween(Window.unboundedPreceding, 0)))
    budget = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget")).first()["budget"]
    edge = (spent.where(F.col("end") > budget)
            .agg(F.min(F.struct("fb", (F.col("end") - F.col("s")).alias("start"))).alias("x")).first()["x"])
    if edge is None:  # every copy fits
        return queued.select("doc_id", "source", "size", "source_size", "target",
                             F.when(F.col("target") > 0, F.col("size") * MAX_PASSES).otherwise(0).cast("long").alias("taken"))
    key = ["f", "u", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("k"), "e"]
    ranked = copies.where(F.col("fb") == edge["fb"]).withColumn("end", F.lit(edge["start"]) + F.sum("size").over(
        Window.orderBy("f", "u", F.col("doc_id").asc_nulls_last(), "e").rowsBetween(Window.unboundedPreceding, 0)))
    last = ranked.where(F.col("end") <= budget).agg(F.max(F.struct(*key)).alias("m")).first()["m"]
    kid = F.coalesce("doc_id", F.lit((1 << 63) - 1))

    def taken(e: int) -> Column:
        f = finish(e)
        below = F.when(f <= 4, F.floor(f * buckets)).otherwise(F.floor((4 + F.log(f / 4)) * buckets)) < edge["fb"]
        if last is not None:
            below = below | (F.struct(f.alias("f"), F.col("u"), kid.alias("k"), F.lit(e).alias("e")) <= F.struct(
                F.lit(last["f"]).alias("f"), F.lit(last["u"]).cast("long").alias("u"),
                F.lit(last["k"]).cast("long").alias("k"), F.lit(last["e"]).alias("e")))
        return F.when(F.col("size") > 0, F.coalesce(below, F.lit(False)).cast("int")).otherwise(0)

    return queued.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("size") * sum((taken(e) for e in range(1, MAX_PASSES)), taken(0))).cast("long").alias("taken"))


SQL = """
with base as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint as u
  from documents),
per as (
  select source, sum(size)::bigint as source_size, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w
  from base group by source),
caps as (
  select *, 3 * source_size as cap, sum(source_size) over () as total,
         coalesce(sum(3 * source_size) over o, 0) as cap_before, sum(w) over r as w_left
  from per
  window o as (order by 3 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding),
         r as (order by 3 * source_size / w, source nulls last rows between current row and unbounded following)),
levels as (
  select *, max(case when cap > (total - cap_before)::double / w_left * w then (total - cap_before)::double / w_left end) over () as level
  from caps),
goal as (
  select source, source_size, case when level is null or cap <= level * w then cap::double else level * w end as target
  from levels),
queued as (
  select b.*, g.source_size, g.target,
         sum(b.size) over (partition by b.source order by u, doc_id nulls last, b.size rows unbounded preceding) as cum
  from base b join goal g on b.source is not distinct from g.source),
copies as (
  select q.doc_id, q.size, q.u, e, (q.source_size * e + q.cum)::double / q.target as f
  from queued q, (values (0), (1), (2)) p(e) where q.size > 0 and q.target > 0),
ranked as (
  select *, sum(size) over (order by f, u, doc_id nulls last, e rows unbounded preceding) as spent from copies),
mixed as (
  select doc_id, size, count(*) as n from ranked
  where spent <= (select coalesce(sum(source_size), 0) from goal) group by doc_id, size)
select q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(m.n, 0))::bigint as taken
from queued q left join mixed m on q.doc_id = m.doc_id and q.size = m.size
"""
