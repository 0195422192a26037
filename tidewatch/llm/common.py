"""Small pieces the text operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words: space and the five ASCII control spaces.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_BLOCK = 256


def text_of(column: str = "text") -> Column:
    """The whole text; a null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WS + "+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(steps: Column) -> Column:
    """Running sums of an array of longs, in blocks, so long arrays stay cheap."""
    def scan(arr: Column, offset: Column) -> Column:
        return F.aggregate(
            arr,
            F.struct(offset.cast("long").alias("acc"), F.array().cast("array<bigint>").alias("out")),
            lambda s, x: F.struct((s["acc"] + x).alias("acc"),
                                  F.concat(s["out"], F.array(s["acc"] + x)).alias("out")),
            lambda s: s["out"])

    def blocked(arr: Column) -> Column:
        n_blocks = F.ceil(F.size(arr) / F.lit(_BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1),
                             lambda b: F.slice(arr, b * _BLOCK + 1, F.lit(_BLOCK)))

        def joined(bl: Column) -> Column:
            totals = F.transform(bl, lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x))
            return let(scan(totals, F.lit(0)),
                       lambda ends: F.flatten(F.transform(bl, lambda a, i: scan(
                           a, F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ends, i - 1))))))

        return let(blocks, joined)

    empty = F.array().cast("array<bigint>")
    return let(steps, lambda a: F.when(F.size(a) == 0, empty)
               .when(F.size(a) <= _BLOCK, scan(a, F.lit(0)))
               .otherwise(blocked(a)))


def mask_of(places: Column) -> Column:
    """1 at the given ascending places and 0 between them; the gaps are filled, so it costs linear time."""
    gaps = F.transform(places, lambda g, i: g - F.when(i == 0, F.lit(-1)).otherwise(F.get(places, i - 1)) - 1)
    return F.concat(F.flatten(F.transform(gaps, lambda n: F.concat(F.array_repeat(F.lit(0), n), F.array(F.lit(1))))))


def ship(module_name: str) -> None:
    """Send a module's functions to the executors by value.

    The Python workers then need not have this package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def fenced(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)``, with the condition read from computed columns.

    Spark would push a filter below the projections that compute its columns
    and so compute them again, nested, for the filter. A filter that also reads
    a row number stays above them.
    """
    return df.withColumn("_fence", F.monotonically_increasing_id()).where((F.col("_fence") >= 0) & condition).drop("_fence")
