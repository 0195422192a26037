"""Read queries of the market dashboard and the run summaries.

Top-k reads compile to TakeOrderedAndProject (per-task top k, then a merge
of k rows per task); "latest date" filters are scalar subqueries computed
once, not joins. Ties in top-k reads are broken by (ticker, date) so the
answer is deterministic. A selected ticker defaults to the first ticker in
sort order, the dashboard's default selection. Where the caller knows the
latest date or the ticker from a cheaper table (a literal, or a scalar subquery
over the price rows), ``latest`` and ``ticker`` take it, so the marts are not
read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import rnd
from tidewatch.functions.signals import direction, return_colour

HEATMAP_DAYS = 14


def _latest_date(df: DataFrame, latest: Column | None = None) -> Column:
    return df.agg(F.max("date")).scalar() if latest is None else latest


def _ticker(df: DataFrame, ticker: str | Column | None) -> Column:
    return F.lit(ticker) if ticker is not None else df.agg(F.min("ticker")).scalar()


# --- Q-1..Q-7: the assistant's facts and the overview tiles -----------------
def overview(sig: DataFrame) -> DataFrame:
    """Distinct tickers, first and last date, and row count."""
    return sig.agg(
        F.count_distinct("ticker").alias("ticker_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def signal_distribution(sig: DataFrame) -> DataFrame:
    """Rows per market signal, most frequent first."""
    return sig.groupBy("market_signal").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "market_signal"
    )


def top_movers(sig: DataFrame, k: int = 5, gainers: bool = True, latest: Column | None = None) -> DataFrame:
    """Top ``k`` gainers (or losers) on the latest date; NULL returns last."""
    rows = sig.where(F.col("date") == _latest_date(sig, latest))
    key = F.desc_nulls_last("daily_return") if gainers else F.asc_nulls_last("daily_return")
    return rows.orderBy(key, "ticker").limit(k).select("ticker", "daily_return", "close", "market_signal")


def top_sensitivity(sens: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` tickers most sensitive to news sentiment."""
    return sens.orderBy(F.desc_nulls_last("sentiment_sensitivity"), "ticker").limit(k).select(
        "ticker", "sentiment_sensitivity", "avg_return_bullish_news", "avg_return_bearish_news"
    )


def latest_vix(sig: DataFrame) -> DataFrame:
    """The most recent non-NULL VIX value (no row if there is none)."""
    return sig.where(F.col("vix_volatility_index").isNotNull()).orderBy(F.desc("date"), "ticker").limit(1).select(
        "vix_volatility_index"
    )


def latest_divergences(sig: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most recent days where price moved against the news."""
    return sig.where(F.col("sentiment_price_alignment") != "aligned").orderBy(F.desc("date"), "ticker").limit(k).select(
        "date", "ticker", "daily_return", "sentiment_ratio", "sentiment_price_alignment"
    )


# --- Q-8..Q-14: overview tab -------------------------------------------------
def ticker_list(sig: DataFrame) -> DataFrame:
    """Distinct tickers in order."""
    return sig.select("ticker").distinct().orderBy("ticker")


def latest_date(sig: DataFrame) -> DataFrame:
    """The latest trading date."""
    return sig.agg(F.max("date").alias("latest_date"))


def latest_day_stats(sig: DataFrame, latest: Column | None = None) -> DataFrame:
    """Average return, up and down counts and average VIX on the latest date."""
    rows = sig.where(F.col("date") == _latest_date(sig, latest))
    return rows.agg(
        rnd(F.avg("daily_return"), 2).alias("avg_return"),
        F.sum(F.when(F.col("daily_return") > 0, 1).otherwise(0)).alias("up_count"),
        F.sum(F.when(F.col("daily_return") < 0, 1).otherwise(0)).alias("down_count"),
        rnd(F.avg("vix_volatility_index"), 1).alias("avg_vix"),
    )


def direction_breakdown(sig: DataFrame) -> DataFrame:
    """Rows per direction (Bullish, Bearish, Neutral) of the market signal."""
    return sig.groupBy(direction().alias("direction")).agg(F.count(F.lit(1)).alias("count"))


def vix_series(sig: DataFrame, ticker: str | Column | None = None) -> DataFrame:
    """VIX by date, read through one ticker's rows."""
    rows = sig.where(F.col("vix_volatility_index").isNotNull() & (F.col("ticker") == _ticker(sig, ticker)))
    return rows.select("date", "vix_volatility_index").orderBy("date")


def recent_returns(sig: DataFrame, days: int = HEATMAP_DAYS, latest: Column | None = None) -> DataFrame:
    """Returns of the last ``days`` days back from the latest date, inclusive."""
    since = F.date_sub(_latest_date(sig, latest), days)
    return sig.where(F.col("date") >= since).select("date", "ticker", "daily_return").orderBy("date", "ticker")


def returns_heatmap(sig: DataFrame, days: int = HEATMAP_DAYS, latest: Column | None = None) -> DataFrame:
    """Ticker x day matrix of daily returns; column ``ret_d{k}`` is k days before the latest date."""
    latest = _latest_date(sig, latest)
    recent = sig.select("ticker", "daily_return", F.date_diff(latest, F.col("date")).alias("days_back")).where(
        F.col("days_back").between(0, days)
    )
    offsets = list(range(days + 1))
    wide = recent.groupBy("ticker").pivot("days_back", offsets).agg(F.max("daily_return"))
    return wide.select("ticker", *[F.col(f"`{k}`").alias(f"ret_d{k}") for k in offsets])


# --- Q-15..Q-17: ticker tab --------------------------------------------------
TICKER_HISTORY_COLUMNS = [
    "date", "open", "high", "low", "close", "volume", "daily_return", "sentiment_ratio",
    "news_article_count", "market_signal", "rolling_7d_avg_close", "volume_spike_ratio",
]


def ticker_history(sig: DataFrame, ticker: str | Column | None = None) -> DataFrame:
    """History of one ticker by date (Parquet partition pruning when stored by ticker)."""
    rows = sig.where(F.col("ticker") == _ticker(sig, ticker))
    return rows.select(*TICKER_HISTORY_COLUMNS, return_colour().alias("return_colour")).orderBy("date")


def ticker_latest(sig: DataFrame, ticker: str | Column | None = None) -> DataFrame:
    """The last row of one ticker."""
    rows = sig.where(F.col("ticker") == _ticker(sig, ticker))
    return rows.orderBy(F.desc("date")).limit(1).select(*TICKER_HISTORY_COLUMNS)


def ticker_sentiment_days(sig: DataFrame, ticker: str | Column | None = None) -> DataFrame:
    """Days of one ticker whose sentiment ratio is not exactly 0."""
    rows = sig.where((F.col("ticker") == _ticker(sig, ticker)) & (F.col("sentiment_ratio") != 0))
    return rows.select(
        "date", "close", "daily_return", "sentiment_ratio", "news_article_count", "market_signal"
    ).orderBy("date")


# --- Q-18..Q-21: sentiment tab -----------------------------------------------
RANKING_COLUMNS = [
    "ticker", "avg_return_bullish_news", "avg_return_bearish_news", "sentiment_sensitivity",
    "avg_abs_return", "worst_day", "best_day",
]


def sensitivity_ranking(sens: DataFrame) -> DataFrame:
    """All tickers by sentiment sensitivity, highest first."""
    return sens.select(*RANKING_COLUMNS).orderBy(F.desc_nulls_last("sentiment_sensitivity"), "ticker")


def top_side_returns(sens: DataFrame, column: str, k: int = 20) -> DataFrame:
    """First ``k`` of the ranking that have a value in ``column``."""
    return (
        sens.where(F.col(column).isNotNull())
        .orderBy(F.desc_nulls_last("sentiment_sensitivity"), "ticker")
        .limit(k)
        .select("ticker", column, "sentiment_sensitivity")
    )


def divergences(sig: DataFrame) -> DataFrame:
    """All divergence days, latest first, largest moves first within a day."""
    return (
        sig.where(F.col("sentiment_price_alignment") != "aligned")
        .select("date", "ticker", "daily_return", "sentiment_ratio", "market_signal", "sentiment_price_alignment")
        .orderBy(F.desc("date"), F.desc(F.abs("daily_return")), "ticker")
    )


# --- Q-22: the assistant's context as rows -----------------------------------
def briefing_facts(sig: DataFrame, sens: DataFrame) -> DataFrame:
    """(section, rank, ticker, date, field, text, value): the facts handed to the assistant, one a row.

    A field is a text (labels and the overview's dates) or a number. Every
    section is a top-k or a count per fixed label, so the numbering windows
    below run over at most ten rows.
    """
    sections = [
        ("overview", overview(sig), F.asc("ticker_count"), ["first_date", "last_date"], ["ticker_count", "row_count"]),
        ("signals", signal_distribution(sig), F.desc("count"), ["market_signal"], ["count"]),
        ("gainers", top_movers(sig, 5, True), F.desc_nulls_last("daily_return"), ["market_signal"], ["daily_return", "close"]),
        ("losers", top_movers(sig, 5, False), F.asc_nulls_last("daily_return"), ["market_signal"], ["daily_return", "close"]),
        ("sensitive", top_sensitivity(sens, 10), F.desc_nulls_last("sentiment_sensitivity"), [],
         ["sentiment_sensitivity", "avg_return_bullish_news", "avg_return_bearish_news"]),
        ("vix", latest_vix(sig), F.asc("vix_volatility_index"), [], ["vix_volatility_index"]),
        ("divergences", latest_divergences(sig, 10), F.desc("date"), ["sentiment_price_alignment"], ["daily_return", "sentiment_ratio"]),
    ]
    out = None
    for name, df, order, texts, values in sections:
        ticker = F.col("ticker") if "ticker" in df.columns else F.lit(None).cast("string")
        date = F.col("date") if "date" in df.columns else F.lit(None).cast("date")
        tie = "market_signal" if name == "signals" else ticker
        facts = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("text"), F.lit(None).cast("double").alias("value")) for c in texts]
        facts += [F.struct(F.lit(c).alias("field"), F.lit(None).cast("string").alias("text"), F.col(c).cast("double").alias("value")) for c in values]
        part = df.select(
            F.lit(name).alias("section"), F.row_number().over(Window.orderBy(order, tie)).alias("rank"),
            ticker.alias("ticker"), date.alias("date"), F.array(*facts).alias("facts"),
        ).select("section", "rank", "ticker", "date", F.inline("facts"))
        out = part if out is None else out.unionByName(part)
    return out


def preview(df: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows of a table in key order (a top-n, not a scan)."""
    return df.orderBy(*keys).limit(n)


# --- R-1..R-5: run summaries -------------------------------------------------
def run_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each step's table."""
    out = None
    for step, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(step).alias("step"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def layer_date_range(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct tickers and date range of each price layer."""
    out = None
    for layer, df in tables.items():
        part = df.agg(
            F.count_distinct("ticker").alias("ticker_count"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        ).select(F.lit(layer).alias("layer"), "ticker_count", "first_date", "last_date")
        out = part if out is None else out.unionByName(part)
    return out


def daily_sentiment_summary(news_by_day: DataFrame) -> DataFrame:
    """Article counts and sentiment ratio per publication date."""
    return news_by_day.select(
        "date", "news_article_count", "sentiment_ratio",
        "positive_news_count", "negative_news_count", "neutral_news_count",
    ).orderBy("date")


def ticker_sentiment_sample(gold: DataFrame, ticker: str | Column | None = None, n: int = 10) -> DataFrame:
    """A sample of one ticker's days with news (the first ``n`` by date)."""
    rows = gold.where(F.col("sentiment_ratio").isNotNull() & (F.col("ticker") == _ticker(gold, ticker)))
    return rows.select(
        "date", "ticker", "close", "daily_return", "news_article_count", "sentiment_ratio",
        "positive_news_count", "negative_news_count",
    ).orderBy("date").limit(n)
