"""Shape landed source payloads into raw (bronze) records.

Prices: one history row per ticker and day -> record with a yyyy-MM-dd date,
prices rounded to 4 digits, integer volume, source and ingestion stamps.
News: search responses (an ``articles`` array per query page) -> one record
per article, the first occurrence of each URL winning in request order.
Macro: observations per series -> long records, NaN and NULL dropped.

The ingestion stamp is an argument (the run's clock), so a re-run of the
same landing folder gives the same records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.exprs import dedup_latest, parse_date, rnd
from tidewatch.operators.joins import semi_join_list
from tidewatch.sources.schemas import MACRO_SERIES, MACRO_SOURCE, NEWS_SOURCE, PRICE_SOURCE, SEARCH_QUERIES, TICKERS

DEFAULT_STAMP = "2024-02-01T06:00:00.000001"


def price_records(history: DataFrame, ingested_at: str = DEFAULT_STAMP, source: str = PRICE_SOURCE) -> DataFrame:
    """(ticker, day_ts, open_px..close_px, volume_raw) -> raw stock records."""
    return history.select(
        "ticker",
        F.date_format("day_ts", "yyyy-MM-dd").alias("date"),
        rnd("open_px", 4).alias("open"),
        rnd("high_px", 4).alias("high"),
        rnd("low_px", 4).alias("low"),
        rnd("close_px", 4).alias("close"),
        F.col("volume_raw").cast("long").alias("volume"),
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def news_records(payloads: DataFrame, queries: Sequence[str] = SEARCH_QUERIES,
                 ingested_at: str = DEFAULT_STAMP, source: str = NEWS_SOURCE) -> DataFrame:
    """Explode search responses; keep the first article per URL (missing URL -> "").

    "First" is request order: query position, then page, then position in
    the response. A URL repeated in many responses is reduced within each
    task before the shuffle (partial group limit of the ranking window).
    """
    query_text = F.element_at(F.array(*[F.lit(q) for q in queries]), F.col("query_pos").cast("int") + 1)
    flat = payloads.select(
        "query_pos", "page", query_text.alias("search_query"),
        F.posexplode("articles").alias("article_pos", "a"),
    )
    rows = flat.select(
        F.coalesce(F.col("a.url"), F.lit("")).alias("url"),
        "query_pos", "page", "article_pos",
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.source.name").alias("source_name"),
        F.col("a.publishedAt").alias("published_at"),
        F.col("a.content").alias("content_snippet"),
        "search_query",
    )
    first = dedup_latest(rows, ["url"], ["query_pos", "page", "article_pos"], ascending=True)
    return first.select(
        "title", "description", "source_name", "url", "published_at", "content_snippet", "search_query",
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def macro_records(observations: DataFrame, series: Sequence[tuple[str, str, str]] = MACRO_SERIES,
                  ingested_at: str = DEFAULT_STAMP, source: str = MACRO_SOURCE) -> DataFrame:
    """(series_id, obs_date, value) -> long macro records for the listed series.

    The series table is a literal map lookup inside the projection, so no
    join runs; ids outside the list are dropped.
    """
    names = F.create_map(*[x for sid, name, _ in series for x in (F.lit(sid), F.lit(name))])
    freqs = F.create_map(*[x for sid, _, freq in series for x in (F.lit(sid), F.lit(freq))])
    kept = observations.where(
        F.col("series_id").isin([sid for sid, _, _ in series])
        & F.col("value").isNotNull()
        & ~F.isnan("value")
    )
    return kept.select(
        "series_id",
        F.element_at(names, F.col("series_id")).alias("series_name"),
        F.date_format("obs_date", "yyyy-MM-dd").alias("date"),
        rnd("value", 4).alias("value"),
        F.element_at(freqs, F.col("series_id")).alias("frequency"),
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def lookback(records: DataFrame, as_of: str, days_back: int, date_col: str = "date") -> DataFrame:
    """Keep records dated within ``days_back`` days up to ``as_of`` (inclusive)."""
    d = parse_date(date_col)
    end = F.to_date(F.lit(as_of))
    return records.where(d.between(F.date_sub(end, days_back), end))


def ticker_universe(records: DataFrame, universe=tuple(TICKERS)) -> DataFrame:
    """Keep rows of tickers in ``universe`` (a list, or a DataFrame with ``ticker``; by default the usual tickers)."""
    return semi_join_list(records, "ticker", universe)
