"""Layer chain from the three raw record sets to the marts.

``Layers`` builds each table lazily from the raw DataFrames and memoises
the DataFrame object (not its data), so one query plan refers to one
subtree per table. Steps are plain function calls; ``batch`` writes the
same tables to storage and reads each back for the next step.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import gold as G
from tidewatch.operators import marts as M
from tidewatch.operators import sentiment as SN
from tidewatch.operators import silver as SV
from tidewatch.operators.joins import materialise
from tidewatch.session import prepare
from tidewatch.sources import fixtures


class Layers:
    """``shared=True`` writes the gold table once (Parquet in the shared
    folder) and builds every later table from that copy: for queries with
    several consumers of gold, which would otherwise each recompute it.
    """

    def __init__(self, raw_stocks: DataFrame, raw_news: DataFrame, raw_macro: DataFrame, shared: bool = False):
        self.raw_stocks = raw_stocks
        self.raw_news = raw_news
        self.raw_macro = raw_macro
        self.shared = shared

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, shared: bool = False) -> "Layers":
        prepare(spark)
        return cls(
            fixtures.raw_stocks(spark, sf_dir),
            fixtures.raw_news(spark, sf_dir),
            fixtures.raw_macro(spark, sf_dir),
            shared,
        )

    # --- silver --------------------------------------------------------------
    @cached_property
    def silver_stocks(self) -> DataFrame:
        return SV.clean_stocks(self.raw_stocks)

    @cached_property
    def latest_date(self) -> Column:
        """The last trading day, read from the price rows alone (re-ingestion adds no day)."""
        return SV.typed_stocks(self.raw_stocks).agg(F.max("date")).scalar()

    @cached_property
    def first_ticker(self) -> Column:
        """The first ticker in sort order, read from the price rows alone."""
        return SV.typed_stocks(self.raw_stocks).agg(F.min("ticker")).scalar()

    @cached_property
    def news_clean(self) -> DataFrame:
        return SV.clean_news(self.raw_news)

    @cached_property
    def news_sentiment(self) -> DataFrame:
        return SN.score_news(self.news_clean)

    @cached_property
    def macro_long(self) -> DataFrame:
        return SV.clean_macro(self.raw_macro)

    @cached_property
    def macro_wide(self) -> DataFrame:
        return SV.macro_wide(self.macro_long)

    @cached_property
    def macro_ffill(self) -> DataFrame:
        return SV.macro_ffill(self.macro_long)

    # --- gold ----------------------------------------------------------------
    @cached_property
    def daily_news(self) -> DataFrame:
        return G.daily_news(self.news_sentiment)

    @cached_property
    def daily_joined(self) -> DataFrame:
        return G.daily_joined(self.silver_stocks, self.daily_news, self.macro_ffill)

    @cached_property
    def gold(self) -> DataFrame:
        gold = G.daily_market_summary(self.silver_stocks, self.daily_news, self.macro_ffill)
        return materialise(gold, "gold") if self.shared else gold

    @cached_property
    def dim_tickers(self) -> DataFrame:
        return G.dim_tickers(self.gold)

    @cached_property
    def sensitivity(self) -> DataFrame:
        return G.sentiment_sensitivity(self.gold)

    # --- marts ---------------------------------------------------------------
    @cached_property
    def stg(self) -> DataFrame:
        return M.stg_daily_market(self.gold)

    @cached_property
    def signals(self) -> DataFrame:
        return M.market_signals(self.stg)

    @cached_property
    def weekly(self) -> DataFrame:
        return M.weekly_summary(self.signals)
