"""Classification rules at every branch edge, with NULL inputs."""

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import signals as S


def labels(spark, values, expr, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_volume_signal_edges(spark):
    got = labels(spark, [2.0, 2.0001, 1.5, 1.5001, 0.5, 0.4999, None], S.volume_signal)
    assert got == ["elevated_volume", "high_volume_spike", "normal_volume", "elevated_volume",
                   "normal_volume", "low_volume", "normal_volume"]


def test_trend_position_edges(spark):
    got = labels(spark, [3.0, 3.01, 1.0, 1.01, -1.0, -1.01, -3.0, -3.01, None], S.trend_position)
    assert got == ["above_trend", "well_above_trend", "at_trend", "above_trend", "at_trend",
                   "below_trend", "below_trend", "well_below_trend", "at_trend"]


def test_vix_risk_edges(spark):
    got = labels(spark, [30.0, 30.1, 20.0, 20.1, 15.0, 15.1, 0.0, None], S.vix_risk_level)
    assert got == ["elevated_anxiety", "high_fear", "normal", "elevated_anxiety", "low_fear",
                   "normal", "low_fear", "unknown"]
    # The worked example: VIX 27.2 reads as elevated anxiety.
    assert labels(spark, [27.2], S.vix_risk_level) == ["elevated_anxiety"]


def test_news_intensity_edges(spark):
    got = labels(spark, [20, 19, 5, 4, 1, 0, None], S.news_intensity, "bigint")
    assert got == ["high_coverage", "moderate_coverage", "moderate_coverage", "low_coverage",
                   "low_coverage", "no_coverage", "no_coverage"]


def test_gap_signal_edges(spark):
    got = labels(spark, [2.0, 2.01, -2.0, -2.01, None], S.gap_signal)
    assert got == ["no_gap", "gap_up", "no_gap", "gap_down", "no_gap"]


def test_week_classification_edges(spark):
    got = labels(spark, [2.0, 2.01, 0.5, 0.51, -0.5, -0.51, -2.0, -2.01, None], S.week_classification)
    assert got == ["up_week", "strong_up_week", "flat_week", "up_week", "flat_week", "down_week",
                   "down_week", "strong_down_week", "flat_week"]


@pytest.mark.parametrize(
    "has, ret, ratio, signal, alignment",
    [
        (True, 1.01, 0.1, "strong_bullish", "aligned"),
        (True, 1.0, 0.1, "slightly_bullish", "aligned"),
        (False, 1.01, 0.1, "slightly_bullish", "aligned"),
        (True, -1.01, -0.1, "strong_bearish", "aligned"),
        (True, -1.01, 0.1, "slightly_bearish", "negative_divergence"),
        (True, 1.01, -0.1, "slightly_bullish", "positive_divergence"),
        (False, 1.6, -0.1, "bullish", "aligned"),
        (True, 1.5, 0.0, "slightly_bullish", "aligned"),
        (True, -1.5, 0.0, "slightly_bearish", "aligned"),
        (True, -1.6, 0.0, "bearish", "aligned"),
        (True, 0.5, 0.0, "neutral", "aligned"),
        (True, -0.5, 0.0, "neutral", "aligned"),
        (True, None, 0.5, "neutral", "aligned"),
    ],
)
def test_market_signal_and_alignment(spark, has, ret, ratio, signal, alignment):
    df = spark.createDataFrame([(has, ret, ratio)], "has_sentiment_data boolean, daily_return double, sentiment_ratio double")
    row = df.select(S.market_signal().alias("m"), S.sentiment_price_alignment().alias("a")).first()
    assert (row.m, row.a) == (signal, alignment)


def test_sentiment_day_type_and_direction(spark):
    assert labels(spark, [0.1, -0.1, 0.0], S.sentiment_day_type) == [
        "bullish_news_day", "bearish_news_day", "mixed_news_day"]
    got = labels(spark, ["strong_bullish", "slightly_bearish", "neutral", None], S.direction, "string")
    assert got == ["Bullish", "Bearish", "Neutral", "Neutral"]
    assert labels(spark, [0.01, 0.0, -1.0, None], S.return_colour) == ["up", "down", "down", "down"]
