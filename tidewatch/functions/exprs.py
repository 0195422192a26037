"""Column expressions shared by every layer. All JVM-side, no Python UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name for ``F.col`` or SQL, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def rnd(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the decimal value of ``c``.

    Plain ``round`` on a double rounds the binary value, so ties such as the
    mean of two 4-digit prices fall either way depending on float error and
    on the engine. Going through decimal(28,10) first fixes the tie rule.
    Values from 1e18 on do not fit that type; they have no digits behind the
    point and stay as they are, as do infinities; NaN becomes NULL.
    """
    value = col_(c)
    return F.coalesce(F.round(value.try_cast("decimal(28,10)"), digits).cast("double"), F.when(
        (F.abs(value) >= 1e17) & ~F.isnan(value.cast("double")), value.cast("double")))


def pct_change(new: str | Column, base: str | Column) -> Column:
    """(new - base) / base * 100; NULL when base is 0 or NULL."""
    return F.try_divide(col_(new) - col_(base), col_(base)) * F.lit(100)


def parse_date(c: str | Column) -> Column:
    """'yyyy-MM-dd' string to DATE; malformed text gives NULL."""
    return F.try_to_date(col_(c), "yyyy-MM-dd")


def parse_ts(c: str | Column) -> Column:
    """ISO-8601 string to a UTC wall-clock TIMESTAMP_NTZ; malformed gives NULL."""
    return F.try_to_timestamp(col_(c)).cast("timestamp_ntz")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], ascending: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order`` (least if ``ascending``),
    the remaining columns breaking ties in the same direction.

    Written as ``row_number() ... = 1``; Spark plans it with a partial
    WindowGroupLimit before the shuffle, so each task keeps one row per key
    and a key with many copies (one day re-ingested many times) ships one row
    per task, not all of its copies. NULL order values rank after non-NULL.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]

    def key(c: str) -> Column:
        return F.asc_nulls_last(c) if ascending else F.desc_nulls_last(c)

    w = Window.partitionBy(*keys).orderBy(*[key(c) for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def case_chain(branches: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching condition wins; NULL conditions fall through."""
    expr = None
    for cond, label in branches:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
