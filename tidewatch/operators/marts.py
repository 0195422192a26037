"""Semantic models on top of the daily gold table: staging, signals, weekly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import signals as S
from tidewatch.functions.exprs import pct_change, rnd

STAGED_MACRO = [
    "federal_funds_rate", "vix_volatility_index", "treasury_yield_spread",
    "consumer_price_index", "unemployment_rate",
]


def stg_daily_market(gold: DataFrame) -> DataFrame:
    """Missing news measures default to 0, with a flag for real news days.

    ``10y_treasury_yield`` is not carried into staging.
    """
    ratio = F.col("sentiment_ratio")
    return gold.select(
        "date", "ticker", "open", "high", "low", "close", "volume", "daily_return", "price_range",
        F.coalesce("news_article_count", F.lit(0).cast("long")).alias("news_article_count"),
        F.coalesce(ratio, F.lit(0.0)).alias("sentiment_ratio"),
        F.coalesce("positive_news_count", F.lit(0).cast("long")).alias("positive_news_count"),
        F.coalesce("negative_news_count", F.lit(0).cast("long")).alias("negative_news_count"),
        F.coalesce("neutral_news_count", F.lit(0).cast("long")).alias("neutral_news_count"),
        F.coalesce("avg_positive_strength", F.lit(0.0)).alias("avg_positive_strength"),
        F.coalesce("avg_negative_strength", F.lit(0.0)).alias("avg_negative_strength"),
        ratio.isNotNull().alias("has_sentiment_data"),
        *STAGED_MACRO,
        "rolling_7d_avg_close", "rolling_7d_avg_volume", "overnight_gap_pct",
        "price_vs_7d_avg_pct", "volume_spike_ratio", "source", "ingested_at",
    )


def market_signals(stg: DataFrame) -> DataFrame:
    """fct_market_signals: 19 pass-through columns and 7 labels."""
    return stg.select(
        "date", "ticker", "high", "low", "open", "close", "daily_return", "volume",
        "sentiment_ratio", "has_sentiment_data", "news_article_count",
        "positive_news_count", "negative_news_count", "federal_funds_rate", "vix_volatility_index",
        "rolling_7d_avg_close", "volume_spike_ratio", "price_vs_7d_avg_pct", "overnight_gap_pct",
        S.market_signal().alias("market_signal"),
        S.volume_signal().alias("volume_signal"),
        S.trend_position().alias("trend_position"),
        S.vix_risk_level().alias("vix_risk_level"),
        S.sentiment_price_alignment().alias("sentiment_price_alignment"),
        S.news_intensity().alias("news_intensity"),
        S.gap_signal().alias("gap_signal"),
    )


def weekly_summary(sig: DataFrame) -> DataFrame:
    """Per ticker and ISO week (Monday start). Partial aggregation per task."""
    has = F.col("has_sentiment_data")

    def count_when(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    weekly = sig.groupBy("ticker", F.trunc("date", "week").alias("week_start")).agg(
        F.min("low").alias("week_low"),
        F.max("high").alias("week_high"),
        F.min_by("open", "date").alias("week_open"),
        F.max_by("close", "date").alias("week_close"),
        rnd(F.avg("daily_return"), 4).alias("avg_daily_return"),
        rnd(F.sum("daily_return"), 4).alias("cumulative_return"),
        F.count(F.lit(1)).alias("trading_days"),
        rnd(F.avg("volume"), 0).cast("long").alias("avg_volume"),
        F.max("volume").alias("max_volume"),
        rnd(F.avg(F.when(has, F.col("sentiment_ratio"))), 4).alias("avg_sentiment_ratio"),
        F.sum(F.when(has, F.col("news_article_count")).otherwise(F.lit(0).cast("long"))).alias("total_articles"),
        count_when(has).alias("days_with_sentiment"),
        count_when(F.col("market_signal").isin("bullish", "strong_bullish")).alias("bullish_days"),
        count_when(F.col("market_signal").isin("bearish", "strong_bearish")).alias("bearish_days"),
        count_when(F.col("volume_signal") == "high_volume_spike").alias("volume_spike_days"),
        count_when(F.col("sentiment_price_alignment") != "aligned").alias("divergence_days"),
        rnd(F.avg("vix_volatility_index"), 2).alias("avg_vix"),
    )
    pct = pct_change("week_close", "week_open")
    return weekly.withColumns(
        {"weekly_return_pct": rnd(pct, 4), "week_classification": S.week_classification(pct)}
    )
