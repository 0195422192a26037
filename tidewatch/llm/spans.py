"""Pattern matches with their positions and context, as arrays in the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import let, prefix_sums

_NONE = "array<struct<m:string,s:bigint,e:bigint,l:string,r:string>>"


def add_matches(df: DataFrame, name: str, text: str, pattern: str, guard: Column, context: int = 24) -> DataFrame:
    """``df`` with an array ``name`` of the non-overlapping matches of ``pattern``.

    Each is (m: match, s, e: code points, end exclusive, l, r: text around).
    Splitting the text at the same pattern gives the stretches between the
    matches, so positions are running sums of lengths. ``guard`` is a cheap
    test without which there can be no match.
    """
    m, g, at = f"_m_{name}", f"_g_{name}", f"_s_{name}"
    df = df.withColumn(m, F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    df = df.withColumn(at, F.when(F.size(m) > 0, prefix_sums(F.transform(m, lambda x, i: (
        F.length(F.get(g, i)) + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(0)).cast("long")))))
    found = F.transform(m, lambda x, i: F.struct(
        x.alias("m"), F.get(at, i).alias("s"), (F.get(at, i) + F.length(x)).alias("e"),
        F.right(F.get(g, i), F.lit(context)).alias("l"), F.left(F.get(g, i + 1), F.lit(context)).alias("r")))
    return df.withColumn(name, F.when(F.size(m) > 0, found).otherwise(F.array().cast(_NONE))).drop(m, g, at)


_BLOCK = 256


def running_max(values: Column) -> Column:
    """Running maxima of an array of longs, in blocks, so long arrays stay cheap."""
    def scan(arr: Column, start: Column) -> Column:
        return F.aggregate(
            arr, F.struct(start.cast("long").alias("top"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct(F.greatest(a["top"], x).alias("top"), F.concat(a["out"], F.array(F.greatest(a["top"], x))).alias("out")),
            lambda a: a["out"])

    def joined(blocks: Column) -> Column:
        lowest = F.lit(-(1 << 63)).cast("long")
        return let(scan(F.transform(blocks, lambda b: F.array_max(b)), lowest), lambda tops: F.flatten(F.transform(
            blocks, lambda b, i: scan(b, F.when(i == 0, lowest).otherwise(F.get(tops, i - 1))))))

    empty = F.array().cast("array<bigint>")
    return let(values, lambda a: F.when(F.size(a) == 0, empty).otherwise(let(F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(a) / F.lit(_BLOCK)).cast("int") - 1), lambda b: F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK))), joined)))


def apart_from(spans: Column, others: Column) -> Column:
    """The ``spans`` (structs with s, e) that overlap none of ``others``, by their end.

    One sweep over the sorted ends: a span is apart if, of the others that
    begin before its end, none reaches beyond its start.
    """
    events = F.array_sort(F.concat(
        F.transform(spans, lambda c: F.struct(c["e"].cast("long").alias("at"), F.lit(0).alias("other"), F.lit(-1).cast("long").alias("e"), c.alias("c"))),
        F.transform(others, lambda b: F.struct(b["s"].cast("long").alias("at"), F.lit(1).alias("other"), b["e"].cast("long").alias("e"),
                                               F.get(spans, F.lit(-1)).alias("c")))))
    return let(events, lambda ev: let(running_max(F.transform(ev, lambda x: x["e"])), lambda top: F.transform(
        F.filter(ev, lambda x, i: (x["other"] == 0) & (F.get(top, i) <= x["c"]["s"])), lambda x: x["c"])))


def clusters(spans: Column) -> Column:
    """The ``spans`` (structs that begin with s, e) in arrays, one for each chain of spans that overlap."""
    def cut(a: Column) -> Column:
        ends = running_max(F.transform(a, lambda x: x["e"].cast("long")))
        return let(ends, lambda top: let(
            F.filter(F.transform(a, lambda x, i: F.when((i == 0) | (F.get(top, i - 1) <= x["s"]), i)), lambda i: i.isNotNull()),
            lambda first: F.transform(first, lambda f, j: F.slice(a, f + 1, F.coalesce(F.get(first, j + 1), F.size(a)) - f))))

    return let(F.array_sort(spans), cut)
