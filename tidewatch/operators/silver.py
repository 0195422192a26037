"""Bronze -> silver: type, clean, de-duplicate, reshape.

Stocks: typed, rows without close/date/ticker dropped, latest ingestion per
(ticker, date) kept, intraday return and range added.
News: typed, dated by publication, untitled rows dropped, one row per URL.
Macro: typed, one value per (series, date), pivoted wide and forward-filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import dedup_latest, parse_date, parse_ts, pct_change, quoted, rnd
from tidewatch.operators.joins import bounded_broadcast, materialise
from tidewatch.sources.schemas import SERIES_NAMES

STOCK_COLUMNS = [
    "ticker", "date", "open", "high", "low", "close",
    "volume", "daily_return", "price_range", "source", "ingested_at",
]
NEWS_COLUMNS = [
    "title", "description", "source_name", "url", "published_at", "date",
    "search_query", "source", "ingested_at",
]
SCORED_NEWS_COLUMNS = [
    "title", "description", "source_name", "url", "published_at", "date", "search_query",
    "sentiment_label", "sentiment_score", "sentiment_directional", "source", "ingested_at",
]


def typed_stocks(raw: DataFrame) -> DataFrame:
    """Typed price rows with close, date and ticker, before re-ingested days are resolved."""
    return raw.select(
        F.col("ticker").cast("string").alias("ticker"),
        parse_date("date").alias("date"),
        F.col("open").try_cast("double").alias("open"),
        F.col("high").try_cast("double").alias("high"),
        F.col("low").try_cast("double").alias("low"),
        F.col("close").try_cast("double").alias("close"),
        F.col("volume").try_cast("long").alias("volume"),
        F.col("source").cast("string").alias("source"),
        parse_ts("ingested_at").alias("ingested_at"),
    ).where(F.col("close").isNotNull() & F.col("date").isNotNull() & F.col("ticker").isNotNull())


def clean_stocks(raw: DataFrame) -> DataFrame:
    """Silver stocks: one row per (ticker, date), the latest ingestion."""
    latest = dedup_latest(typed_stocks(raw), ["ticker", "date"], ["ingested_at"])
    return latest.withColumns(
        {
            "daily_return": rnd(pct_change("close", "open"), 4),
            "price_range": rnd(F.col("high") - F.col("low"), 4),
        }
    ).select(*STOCK_COLUMNS)


def clean_news(raw: DataFrame) -> DataFrame:
    """Silver news without model columns: one row per URL (NULL URLs are one key)."""
    typed = raw.select(
        "title", "description", "source_name", "url",
        parse_ts("published_at").alias("published_at"),
        "search_query", "source",
        parse_ts("ingested_at").alias("ingested_at"),
    ).where(F.col("title").isNotNull())
    typed = typed.withColumn("date", F.to_date("published_at"))
    latest = dedup_latest(typed, ["url"], ["ingested_at", "published_at", "title"])
    return latest.select(*NEWS_COLUMNS)


def typed_macro(raw: DataFrame) -> DataFrame:
    """Typed macro records with value and date, before re-ingested ones are resolved."""
    return raw.select(
        "series_id", "series_name",
        parse_date("date").alias("date"),
        F.col("value").try_cast("double").alias("value"),
        "frequency", "source",
        parse_ts("ingested_at").alias("ingested_at"),
    ).where(F.col("value").isNotNull() & F.col("date").isNotNull())


def clean_macro(raw: DataFrame) -> DataFrame:
    """Long macro records: typed, one value per (series_name, date), latest ingestion."""
    return dedup_latest(typed_macro(raw), ["series_name", "date"], ["ingested_at"])


# More series than this are not columns any more; such a table is refused.
MAX_SERIES = 2_000


def series_found(long: DataFrame, known: list[str] = SERIES_NAMES) -> list[str]:
    """The known series, then every other one that ``long`` holds, in order of its name.

    Names are collected, at most ``MAX_SERIES`` of them: what an unknown series
    holds is kept as a column of its own instead of being lost in the pivot.
    """
    new = long.where(F.col("series_name").isNotNull() & ~F.col("series_name").isin(list(known))).select("series_name").distinct()
    found = sorted(r.series_name for r in new.limit(MAX_SERIES + 1).collect())
    if len(found) > MAX_SERIES:
        raise ValueError(f"more than {MAX_SERIES} unknown macro series")
    # Names that differ in case only cannot both be columns.
    taken = {"date", *(s.lower() for s in known)}
    out = list(known)
    for name in found:
        if name.lower() in taken:
            raise ValueError(f"macro series {name!r} clashes with another column")
        taken.add(name.lower())
        out.append(name)
    return out


def macro_wide(long: DataFrame, series: list[str] = SERIES_NAMES) -> DataFrame:
    """One row per date, one column per series of the list (absent -> NULL column)."""
    return long.groupBy("date").pivot("series_name", list(series)).agg(F.max("value")).select(
        "date", *[F.col(quoted(s)) for s in series]
    )


def forward_fill(df: DataFrame, key: str, order: str, value: str, bucket: Column) -> DataFrame:
    """Carry the last non-NULL ``value`` forward within each ``key``, by ``order``.

    Two levels, so a long or dominant key is not one task: rows are filled
    inside (key, bucket) partitions in parallel; a per-bucket summary (its
    last non-NULL value, one row per key and bucket) is carried across
    buckets by a window over that small table; its result fills what is
    still NULL at the start of each bucket. The summary has one row per
    bucket, so it is joined back with a size-checked broadcast.
    """
    b = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_filled", F.last(value, ignorenulls=True).over(inside))
    last_in_bucket = b.groupBy(key, "_bucket").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_last")
    )
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_in_bucket.select(key, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    out = b.join(bounded_broadcast(carried), [key, "_bucket"], "left")
    return out.withColumn(value, F.coalesce("_filled", "_carry")).drop("_bucket", "_filled", "_carry")


def macro_ffill(long: DataFrame, series: list[str] = SERIES_NAMES, bucket: str = "month") -> DataFrame:
    """Wide macro table with every series carried forward over all macro dates.

    The fill runs in long form on the date spine (every date any series has,
    so a date with one series still gets the carried values of the others),
    partitioned by series and ``bucket`` (a ``trunc`` unit of the date): see
    ``forward_fill``. Before a series starts its value stays NULL. The wide
    table (a row per date) is stored once, as the fill reads it twice.
    """
    wide = materialise(macro_wide(long, series), "macro-wide")
    stacked = wide.unpivot("date", [quoted(s) for s in series], "series_name", "value")
    filled = forward_fill(stacked, "series_name", "date", "value", F.trunc("date", bucket))
    return macro_wide(filled, series)
