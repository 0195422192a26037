"""Business classification rules. Each is a CASE chain: first match wins,
comparisons are strict, and a NULL input falls through to the last branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.exprs import case_chain, col_

# --- fixed values: label sets checked by the data tests ---------------------
MARKET_SIGNALS = [
    "strong_bullish",
    "bullish",
    "slightly_bullish",
    "neutral",
    "slightly_bearish",
    "bearish",
    "strong_bearish",
]
VOLUME_SIGNALS = ["high_volume_spike", "elevated_volume", "normal_volume", "low_volume"]
TREND_POSITIONS = ["well_above_trend", "above_trend", "at_trend", "below_trend", "well_below_trend"]
NEWS_INTENSITIES = ["high_coverage", "moderate_coverage", "low_coverage", "no_coverage"]
BULLISH_SIGNALS = ["strong_bullish", "bullish", "slightly_bullish"]
BEARISH_SIGNALS = ["strong_bearish", "bearish", "slightly_bearish"]


def sentiment_day_type(ratio: str | Column = "sentiment_ratio") -> Column:
    r = col_(ratio)
    return case_chain([(r > 0, "bullish_news_day"), (r < 0, "bearish_news_day")], "mixed_news_day")


def market_signal(has: str | Column = "has_sentiment_data", ret: str | Column = "daily_return",
                  ratio: str | Column = "sentiment_ratio") -> Column:
    h, r, s = col_(has), col_(ret), col_(ratio)
    return case_chain(
        [
            ((h == F.lit(True)) & (r > 1.0) & (s > 0), "strong_bullish"),
            ((h == F.lit(True)) & (r < -1.0) & (s < 0), "strong_bearish"),
            (r > 1.5, "bullish"),
            (r < -1.5, "bearish"),
            (r > 0.5, "slightly_bullish"),
            (r < -0.5, "slightly_bearish"),
        ],
        "neutral",
    )


def volume_signal(ratio: str | Column = "volume_spike_ratio") -> Column:
    v = col_(ratio)
    return case_chain(
        [(v > 2.0, "high_volume_spike"), (v > 1.5, "elevated_volume"), (v < 0.5, "low_volume")],
        "normal_volume",
    )


def trend_position(pct: str | Column = "price_vs_7d_avg_pct") -> Column:
    p = col_(pct)
    return case_chain(
        [
            (p > 3.0, "well_above_trend"),
            (p > 1.0, "above_trend"),
            (p < -3.0, "well_below_trend"),
            (p < -1.0, "below_trend"),
        ],
        "at_trend",
    )


def vix_risk_level(vix: str | Column = "vix_volatility_index") -> Column:
    v = col_(vix)
    return case_chain(
        [(v > 30, "high_fear"), (v > 20, "elevated_anxiety"), (v > 15, "normal"), (v.isNotNull(), "low_fear")],
        "unknown",
    )


def sentiment_price_alignment(has: str | Column = "has_sentiment_data", ret: str | Column = "daily_return",
                              ratio: str | Column = "sentiment_ratio") -> Column:
    h, r, s = col_(has), col_(ret), col_(ratio)
    return case_chain(
        [
            ((h == F.lit(True)) & (s > 0) & (r < -1.0), "negative_divergence"),
            ((h == F.lit(True)) & (s < 0) & (r > 1.0), "positive_divergence"),
        ],
        "aligned",
    )


def news_intensity(count: str | Column = "news_article_count") -> Column:
    n = col_(count)
    return case_chain(
        [(n >= 20, "high_coverage"), (n >= 5, "moderate_coverage"), (n >= 1, "low_coverage")],
        "no_coverage",
    )


def gap_signal(gap: str | Column = "overnight_gap_pct") -> Column:
    g = col_(gap)
    return case_chain([(g > 2.0, "gap_up"), (g < -2.0, "gap_down")], "no_gap")


def week_classification(pct: Column) -> Column:
    """On the unrounded weekly percent change."""
    return case_chain(
        [
            (pct > 2.0, "strong_up_week"),
            (pct > 0.5, "up_week"),
            (pct < -2.0, "strong_down_week"),
            (pct < -0.5, "down_week"),
        ],
        "flat_week",
    )


def direction(signal: str | Column = "market_signal") -> Column:
    s = col_(signal)
    return case_chain([(s.isin(BULLISH_SIGNALS), "Bullish"), (s.isin(BEARISH_SIGNALS), "Bearish")], "Neutral")


def return_colour(ret: str | Column = "daily_return") -> Column:
    """Up/down flag of a return, as the bar colour of a returns chart."""
    return case_chain([(col_(ret) > 0, "up")], "down")
