"""Joins against small, date-keyed sides, broadcast only after a size check.

Daily news and the macro table hold one row per calendar date, so their
size follows the date span, not the data volume. That is a bound by
construction, but bad input (dates centuries apart) could still break it,
so the side is written once to the shared checkpoint folder, its rows
counted during that write. Within the bound it is broadcast; beyond it the
join is left to a shuffle join, where adaptive execution splits skewed dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

# A date-keyed side of 200k rows is ~550 years of days: a few tens of MB.
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def materialise(df: DataFrame, name: str = "stage", counted: bool = False):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the chain), and later readers get a columnar scan with pruning and
    accurate size statistics. With ``counted=True`` also returns the number
    of rows written, observed during the write (no second job).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    stored = spark.read.parquet(path)
    return (stored, int(obs.get["rows"])) if counted else stored


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` as is."""
    small, n = materialise(df, "small-side", counted=True)
    return F.broadcast(small) if n <= max_rows else small


def bounded_broadcasts(dfs: list[DataFrame], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> list[DataFrame]:
    """``bounded_broadcast`` of independent sides, their jobs submitted together.

    The sides share no work, so their write-and-count jobs run at the same
    time on the cluster instead of one after the other.
    """
    if len(dfs) <= 1:
        return [bounded_broadcast(df, max_rows) for df in dfs]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(lambda d: bounded_broadcast(d, max_rows), dfs))


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "left",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    return big.join(bounded_broadcast(small, max_rows), on=on, how=how)


def semi_join_list(df: DataFrame, column: str, values) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``.

    A Python list becomes an IN-set predicate that reaches the Parquet scan;
    a DataFrame is semi-joined, broadcast only within the size bound.
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(column)).distinct()
        return df.join(bounded_broadcast(keys), on=column, how="left_semi")
    return df.where(F.col(column).isin(list(values)))
