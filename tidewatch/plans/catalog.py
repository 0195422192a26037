"""Named queries over the test tables: key -> (spark, sf_dir) -> DataFrame.

Each query builds the raw record sets from the test tables, then runs the
layer chain up to what it reads. Nothing is collected here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import gold as G
from tidewatch.operators import quality as Q
from tidewatch.operators import sentiment as SN
from tidewatch.operators.joins import materialise
from tidewatch.plans import reports as R
from tidewatch.plans import batch as P
from tidewatch.plans.layers import Layers
from tidewatch.session import prepare, scratch_path
from tidewatch.sources import fixtures, schemas
from tidewatch.sources import landed as LD
from tidewatch.sources import raw as RW
from tidewatch.sources import storage as io
from tidewatch.sources.copying import copy_layers
from tidewatch.sources.intake import take_in

Query = Callable[[SparkSession, str], DataFrame]


def _on(fn: Callable[[Layers], DataFrame], shared: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers.from_testdata(spark, sf_dir, shared))

    run.__doc__ = fn.__doc__
    return run


def model_tables(L: Layers) -> dict[str, DataFrame]:
    return {
        "fct_daily_market_summary": L.gold,
        "dim_tickers": L.dim_tickers,
        "fct_sentiment_sensitivity": L.sensitivity,
        "stg_daily_market": L.stg,
        "fct_market_signals": L.signals,
        "fct_weekly_summary": L.weekly,
    }


def step_tables(L: Layers) -> dict[str, DataFrame]:
    return {
        "raw_stocks": L.raw_stocks,
        "silver_stocks": L.silver_stocks,
        "raw_news": L.raw_news,
        "silver_news": L.news_sentiment,
        "raw_macro": L.raw_macro,
        "macro_long": L.macro_long,
        "silver_macro": L.macro_ffill,
        "fct_daily_market_summary": L.gold,
        "dim_tickers": L.dim_tickers,
        "fct_sentiment_sensitivity": L.sensitivity,
        "fct_market_signals": L.signals,
        "fct_weekly_summary": L.weekly,
    }


# Run date of the lookback query, and the ticker universe of the universe
# query: the first 55 listed tickers, the size of the default universe.
LOOKBACK_AS_OF = "2024-01-20"
UNIVERSE = [f"T{i:06d}" for i in range(55)]


# The tables that a whole batch leaves in the lake.
LAKE_TABLES = [("bronze", "stocks"), ("bronze", "news"), ("bronze", "fred"), ("silver", "stocks"), ("silver", "news"), ("silver", "fred"),
               *(("gold", t) for t in P.GOLD_TABLES), ("marts", "fct_market_signals"), ("marts", "fct_weekly_summary"), ("marts", "quality_report")]

# Buckets of the bucketed round trip.
ROUNDTRIP_BUCKETS = 16


def _price_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return RW.price_records(fixtures.raw_table(spark, sf_dir, "price_history"))


def _news_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return RW.news_records(fixtures.news_payloads(spark, sf_dir))


def _macro_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return RW.macro_records(fixtures.raw_table(spark, sf_dir, "macro_obs"))


def _roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers.from_testdata(spark, sf_dir)
    path = scratch_path(spark, "bronze-stocks")
    io.append_json(L.raw_stocks, path)
    return io.read_raw_json(spark, path, schemas.RAW_STOCKS)


def _intake(source: str, payloads: Callable[[SparkSession, str], DataFrame], schema) -> Query:
    """Payload files taken in twice, as by a run that is repeated: each file counts once."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        root = scratch_path(spark, "intake")
        LD.write_json_arrays(payloads(spark, sf_dir), f"{root}/landing/{source}")
        for _ in range(2):
            take_in(spark, root, source, f"{root}/landing/{source}", RW.DEFAULT_STAMP)
        return io.read_raw_json(spark, f"{root}/bronze/{source}", schema)

    return run


def _roundtrip_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of array files and of files by line, read together."""
    L = Layers.from_testdata(spark, sf_dir)
    path = scratch_path(spark, "bronze-mixed")
    as_array = F.col("date") < "2024-01-15"
    LD.write_json_arrays(L.raw_stocks.where(as_array), path)
    io.append_json(L.raw_stocks.where(~F.coalesce(as_array, F.lit(False))), path)
    return LD.read_landed_json(spark, path, schemas.RAW_STOCKS)


def _roundtrip_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers.from_testdata(spark, sf_dir)
    path = scratch_path(spark, "silver-stocks")
    io.write_partitioned(L.silver_stocks, path)
    return io.read_table(spark, path, schemas.SILVER_STOCKS)


def _roundtrip_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers.from_testdata(spark, sf_dir)
    path = scratch_path(spark, "silver-bucketed")
    table = "silver_" + uuid.uuid4().hex
    io.write_bucketed(L.silver_stocks, path, table, ROUNDTRIP_BUCKETS)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay, as for a new session
    return io.bucketed_table(spark, table, path)


def _gold_tables(spark: SparkSession, sf_dir: str) -> list[str]:
    L = Layers.from_testdata(spark, sf_dir, shared=True)
    root = scratch_path(spark, "gold")
    io.write_partitioned(L.gold, f"{root}/fct_daily_market_summary")
    io.write_flat(L.dim_tickers, f"{root}/dim_tickers")
    io.write_flat(L.sensitivity, f"{root}/fct_sentiment_sensitivity")
    return io.register_tables(spark, root, P.GOLD_TABLES)


def _roundtrip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.table_listing(spark, _gold_tables(spark, sf_dir))


def _table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.column_listing(spark, _gold_tables(spark, sf_dir))


def _layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table of the lake after a whole batch: has it files and bytes, and how many rows do they hold?"""
    L = Layers.from_testdata(spark, sf_dir)
    root = scratch_path(spark, "lake")
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root)
    rows = None
    for layer, table in LAKE_TABLES:
        path = f"{root}/{layer}/{table}"
        stored = spark.read.text(path) if layer == "bronze" else io.read_table(spark, path)
        part = stored.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "row_count")
        rows = part if rows is None else rows.unionByName(part)
    found = io.layer_inventory(spark, root).select(
        "layer", "table", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))
    return found.join(rows, ["layer", "table"], "left")


def _layer_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each table of the lake's copy under another root, and whether the copy is whole."""
    L = Layers.from_testdata(spark, sf_dir)
    root = scratch_path(spark, "lake")
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root)
    return copy_layers(spark, root, scratch_path(spark, "lake-copy")).select("layer", "table", "row_count", "passed")


def _run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every step's table; what later steps read is stored once."""
    L = Layers.from_testdata(spark, sf_dir, shared=True)
    L.silver_stocks = materialise(L.silver_stocks, "silver-stocks")
    L.macro_long = materialise(L.macro_long, "silver-macro")
    return R.run_counts(step_tables(L))


QUERIES: dict[str, Query] = {
    # raw records and landing
    "raw_price_records": _price_records,
    "raw_news_records": _news_records,
    "raw_macro_records": _macro_records,
    "intake_price_records": _intake("stocks", lambda spark, sf_dir: fixtures.raw_table(spark, sf_dir, "price_history"), schemas.RAW_STOCKS),
    "intake_news_records": _intake("news", fixtures.news_payloads, schemas.RAW_NEWS),
    "intake_macro_records": _intake("fred", lambda spark, sf_dir: fixtures.raw_table(spark, sf_dir, "macro_obs"), schemas.RAW_MACRO),
    "lookback_window": lambda spark, sf_dir: RW.lookback(_macro_records(spark, sf_dir), LOOKBACK_AS_OF, schemas.LOOKBACK_DAYS),
    "ticker_universe": lambda spark, sf_dir: RW.ticker_universe(_price_records(spark, sf_dir), UNIVERSE),
    # storage round trips
    "roundtrip_json": _roundtrip_json,
    "roundtrip_json_array": _roundtrip_json_array,
    "roundtrip_partitioned": _roundtrip_partitioned,
    "roundtrip_bucketed": _roundtrip_bucketed,
    "roundtrip_tables": _roundtrip_tables,
    "table_catalog": _table_catalog,
    "layer_inventory": _layer_inventory,
    "layer_copy": _layer_copy,
    "table_preview": _on(lambda L: R.preview(L.dim_tickers, ["ticker"], 3)),
    # silver
    "silver_stocks": _on(lambda L: L.silver_stocks),
    "news_clean": _on(lambda L: L.news_clean),
    "news_sentiment": _on(lambda L: L.news_sentiment),
    "news_scored_by_model": _on(lambda L: SN.score_news_with_model(L.news_clean)),
    "macro_long_clean": _on(lambda L: L.macro_long),
    "macro_wide": _on(lambda L: L.macro_wide),
    "macro_ffill": _on(lambda L: L.macro_ffill),
    # gold
    "daily_news": _on(lambda L: L.daily_news),
    "daily_headlines": _on(lambda L: G.daily_headlines(L.news_sentiment)),
    "daily_joined": _on(lambda L: L.daily_joined),
    "price_features": _on(lambda L: G.add_price_features(L.silver_stocks)),
    "fct_daily_market_summary": _on(lambda L: L.gold),
    "dim_tickers": _on(lambda L: L.dim_tickers),
    "sentiment_day_types": _on(lambda L: G.sentiment_day_types(L.gold)),
    "fct_sentiment_sensitivity": _on(lambda L: L.sensitivity),
    # marts
    "stg_daily_market": _on(lambda L: L.stg),
    "fct_market_signals": _on(lambda L: L.signals),
    "fct_weekly_summary": _on(lambda L: L.weekly),
    # quality
    "quality_not_null": _on(lambda L: Q.run_checks(model_tables(L), tests=["not_null"]), shared=True),
    "quality_unique": _on(lambda L: Q.run_checks(model_tables(L), tests=["unique"]), shared=True),
    "quality_accepted_values": _on(lambda L: Q.run_checks(model_tables(L), tests=["accepted_values"]), shared=True),
    "quality_report": _on(lambda L: Q.quality_report(model_tables(L)), shared=True),
    # dashboard reads
    "overview": _on(lambda L: R.overview(L.signals)),
    "signal_distribution": _on(lambda L: R.signal_distribution(L.signals)),
    "top_gainers": _on(lambda L: R.top_movers(L.signals, 5, True, L.latest_date)),
    "top_losers": _on(lambda L: R.top_movers(L.signals, 5, False, L.latest_date)),
    "top_sensitivity": _on(lambda L: R.top_sensitivity(L.sensitivity, 10)),
    "latest_vix": _on(lambda L: R.latest_vix(L.signals)),
    "latest_divergences": _on(lambda L: R.latest_divergences(L.signals, 10)),
    "ticker_list": _on(lambda L: R.ticker_list(L.signals)),
    "latest_date": _on(lambda L: R.latest_date(L.signals)),
    "latest_day_stats": _on(lambda L: R.latest_day_stats(L.signals, L.latest_date)),
    "direction_breakdown": _on(lambda L: R.direction_breakdown(L.signals)),
    "vix_series": _on(lambda L: R.vix_series(L.signals, L.first_ticker)),
    "recent_returns": _on(lambda L: R.recent_returns(L.signals, latest=L.latest_date)),
    "returns_heatmap": _on(lambda L: R.returns_heatmap(L.signals, latest=L.latest_date)),
    "ticker_history": _on(lambda L: R.ticker_history(L.signals, L.first_ticker)),
    "ticker_latest": _on(lambda L: R.ticker_latest(L.signals, L.first_ticker)),
    "ticker_sentiment_days": _on(lambda L: R.ticker_sentiment_days(L.signals, L.first_ticker)),
    "sensitivity_ranking": _on(lambda L: R.sensitivity_ranking(L.sensitivity)),
    "top_bullish_returns": _on(lambda L: R.top_side_returns(L.sensitivity, "avg_return_bullish_news", 20)),
    "top_bearish_returns": _on(lambda L: R.top_side_returns(L.sensitivity, "avg_return_bearish_news", 20)),
    "divergences": _on(lambda L: R.divergences(L.signals)),
    "briefing_facts": _on(lambda L: R.briefing_facts(L.signals, L.sensitivity), shared=True),
    # run summaries
    "run_counts": _run_counts,
    "layer_date_range": _on(
        lambda L: R.layer_date_range({"silver_stocks": L.silver_stocks, "fct_daily_market_summary": L.gold}),
        shared=True,
    ),
    "label_breakdown": _on(lambda L: SN.label_breakdown(L.news_sentiment)),
    "daily_sentiment_summary": _on(lambda L: R.daily_sentiment_summary(L.daily_news)),
    "ticker_sentiment_sample": _on(lambda L: R.ticker_sentiment_sample(L.gold, L.first_ticker)),
}
