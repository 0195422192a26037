"""Dashboard reads on hand-built frames: ordering, ties, NULLs, offsets."""

import datetime as dt

from tidewatch.plans import reports as R

D = dt.date
SIG = ("date date, ticker string, daily_return double, close double, market_signal string, "
       "sentiment_ratio double, news_article_count bigint, vix_volatility_index double")


def sig(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SIG)
    return df.withColumns({
        "open": F.col("close"), "high": F.col("close"), "low": F.col("close"), "volume": F.lit(1).cast("long"),
        "rolling_7d_avg_close": F.col("close"), "volume_spike_ratio": F.lit(1.0),
    })


def test_top_movers_ties_and_nulls(spark):
    day = D(2024, 1, 31)
    df = sig(spark, [
        (day, "B", 2.0, 10.0, "bullish", 0.0, 0, 20.0),
        (day, "A", 2.0, 10.0, "bullish", 0.0, 0, 20.0),
        (day, "C", None, 10.0, "neutral", 0.0, 0, 20.0),
        (day, "D", -3.0, 10.0, "bearish", 0.0, 0, 20.0),
        (D(2024, 1, 30), "E", 9.0, 10.0, "bullish", 0.0, 0, 20.0),  # not the latest date
    ])
    assert [r.ticker for r in R.top_movers(df, 5, True).collect()] == ["A", "B", "D", "C"]
    assert [r.ticker for r in R.top_movers(df, 5, False).collect()] == ["D", "A", "B", "C"]  # NULLs last
    assert [r.ticker for r in R.top_movers(df, 1, True).collect()] == ["A"]


def test_heatmap_offsets_and_cutoff(spark):
    latest = D(2024, 2, 20)
    rows = [(latest - dt.timedelta(days=k), "T", float(k), 1.0, "neutral", 0.0, 0, None) for k in (0, 3, 14, 15)]
    out = R.returns_heatmap(sig(spark, rows)).first()
    assert (out.ret_d0, out.ret_d3, out.ret_d14, out.ret_d1) == (0.0, 3.0, 14.0, None)
    assert "ret_d15" not in out.asDict()
    recent = R.recent_returns(sig(spark, rows)).collect()
    assert sorted(r.daily_return for r in recent) == [0.0, 3.0, 14.0]  # 14 days back is inclusive


def test_ticker_reads_default_to_first_ticker_and_hide_zero_ratio(spark):
    rows = [
        (D(2024, 1, 2), "B", 1.0, 10.0, "neutral", 0.5, 3, 15.0),
        (D(2024, 1, 2), "A", 1.0, 10.0, "neutral", 0.0, 0, 15.0),
        (D(2024, 1, 3), "A", -2.0, 11.0, "bearish", -0.25, 2, None),
        (D(2024, 1, 4), "A", 0.5, 12.0, "neutral", 0.0, 1, 16.0),
    ]
    df = sig(spark, rows)
    days = R.ticker_sentiment_days(df).collect()
    assert [(r.date, r.sentiment_ratio) for r in days] == [(D(2024, 1, 3), -0.25)]
    assert R.ticker_latest(df).first().date == D(2024, 1, 4)
    assert [r.date for r in R.vix_series(df).collect()] == [D(2024, 1, 2), D(2024, 1, 4)]
    assert [r.date for r in R.ticker_history(df, "B").collect()] == [D(2024, 1, 2)]
    stats = R.latest_day_stats(df).first()
    assert (stats.avg_return, stats.up_count, stats.down_count, stats.avg_vix) == (0.5, 1, 0, 16.0)
