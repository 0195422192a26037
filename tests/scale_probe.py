"""Scale probe (a tool, not a test): amplified prices with one very hot key.

Each raw price row of the given scale factor is repeated ``copies`` times
under new tickers (``explode(sequence(...))``, no join), and one
(ticker, date) gets as many extra re-ingested copies as a third of all rows.
Prints the seconds for silver and for gold, and checks that the hot key
resolves to its latest copy.

Usage: python tests/scale_probe.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str = "/root/testdata/sf0.1", copies: int = 100) -> None:
    from pyspark.sql import functions as F

    from tidewatch.operators import gold as G
    from tidewatch.operators import silver as SV
    from tidewatch.operators.joins import materialise
    from tidewatch.plans.layers import Layers
    from tidewatch.session import local_session

    spark = local_session(8, shuffle_partitions=16)
    L = Layers.from_testdata(spark, sf_dir)
    base = L.raw_stocks
    wide = base.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k"), *base.columns).select(
        F.concat("ticker", F.lit("_"), F.col("k").cast("string")).alias("ticker"),
        *[c for c in base.columns if c != "ticker"],
    )
    wide = materialise(wide, "probe-wide")
    n = wide.count()
    hot_n = n // 2  # a third of all rows after the union
    first = wide.select("ticker", "date").orderBy("ticker", "date").first()
    hot = spark.range(hot_n).select(
        F.lit(first.ticker).alias("ticker"), F.lit(first.date).alias("date"),
        F.lit(100.0).alias("open"), F.lit(101.0).alias("high"), F.lit(99.0).alias("low"),
        (F.col("id") / 1e6 + 100).alias("close"), F.lit(1000).cast("long").alias("volume"),
        F.lit("copy").alias("source"),
        F.format_string("2030-01-01T00:00:00.%06d", (F.col("id") % 1_000_000).cast("int")).alias("ingested_at"),
    )
    raw = materialise(wide.unionByName(hot), "probe-raw")
    total = raw.count()
    print(f"raw rows {total}, hot key rows {hot_n} ({hot_n / total:.0%})")

    t = time.perf_counter()
    silver = materialise(SV.clean_stocks(raw), "probe-silver")
    print(f"silver {time.perf_counter() - t:.1f}s rows {silver.count()}")
    t = time.perf_counter()
    G.daily_market_summary(silver, L.daily_news, L.macro_ffill).write.format("noop").mode("overwrite").save()
    print(f"gold {time.perf_counter() - t:.1f}s")
    latest = silver.where((F.col("ticker") == first.ticker) & (F.col("date") == F.to_date(F.lit(first.date))))
    row = latest.select("ingested_at").first()
    assert str(row.ingested_at).startswith("2030-01-01"), row
    print("hot key resolved to", row.ingested_at)

    # Text path: whole documents under new URLs, plus one URL re-ingested
    # until it holds a third of the rows (a syndicated story).
    from tidewatch.operators import sentiment as SN

    news_copies = max(1, copies // 10)
    raw_news = L.raw_news
    wide_news = raw_news.select(
        F.explode(F.sequence(F.lit(0), F.lit(news_copies - 1))).alias("k"), *raw_news.columns
    ).withColumn("url", F.concat("url", F.lit("#"), F.col("k").cast("string"))).drop("k")
    wide_news = materialise(wide_news, "probe-news")
    n_news = wide_news.count()
    hot_url = wide_news.where(F.col("title").isNotNull()).select("url").first().url
    hot_news = wide_news.where(F.col("url") == hot_url).select(
        F.explode(F.sequence(F.lit(1), F.lit(n_news // 2))).alias("i"), *[c for c in raw_news.columns]
    ).withColumn("ingested_at", F.format_string("2030-01-01T00:00:00.%06d", F.col("i"))).drop("i")
    news = materialise(wide_news.unionByName(hot_news), "probe-news-raw")
    total_news = news.count()
    text_bytes = news.agg(F.sum(F.length("title"))).first()[0]
    print(f"raw news rows {total_news}, hot URL rows {n_news // 2} ({(n_news // 2) / total_news:.0%}), "
          f"{text_bytes / 1e6:.0f} M characters")
    t = time.perf_counter()
    scored = materialise(SN.score_news(SV.clean_news(news)), "probe-news-silver")
    print(f"news silver (dedup + whole-text scoring + write) {time.perf_counter() - t:.1f}s rows {scored.count()}")
    hot = scored.where(F.col("url") == hot_url).select("ingested_at").first()
    assert str(hot.ingested_at).startswith("2030-01-01"), hot
    print("hot URL resolved to", hot.ingested_at)
    spark.stop()


if __name__ == "__main__":
    args = sys.argv[1:]
    main(args[0] if args else "/root/testdata/sf0.1", int(args[1]) if len(args) > 1 else 100)
