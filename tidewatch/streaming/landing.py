"""Incremental silver tables from the landing folders, with Structured Streaming.

The batch pipeline rebuilds silver from all of bronze each day. When landing
batches arrive through the day, the same cleaning can run on new files only:
``readStream`` picks up files not seen before (tracked in the checkpoint),
each micro-batch is typed, cleaned (and for news, scored) and written as one
increment. A day or URL re-ingested later appears in several increments;
``silver_view`` resolves them with the batch step's own latest-ingestion
rule, so the view equals the batch result over the same files.

Use ``trigger(availableNow=True)`` from a scheduler: it processes what has
landed and stops, and resumes from its checkpoint after a restart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.exprs import dedup_latest
from tidewatch.operators import sentiment as SN
from tidewatch.operators import silver as SV
from tidewatch.sources import schemas


@dataclass(frozen=True)
class Source:
    raw_schema: T.StructType
    clean: Callable[[DataFrame], DataFrame]  # one micro-batch of raw records -> increment
    keys: list[str]
    order: list[str]  # latest-wins order, with the batch step's tie-breaks
    finish: Callable[[DataFrame], DataFrame]  # resolved increments -> silver table


SOURCES: dict[str, Source] = {
    "stocks": Source(
        schemas.RAW_STOCKS, SV.clean_stocks, ["ticker", "date"], ["ingested_at", "open", "high", "low", "close", "volume", "source"],
        lambda df: df.select(*SV.STOCK_COLUMNS),
    ),
    "news": Source(
        schemas.RAW_NEWS, lambda df: SN.score_news(SV.clean_news(df)), ["url"],
        ["ingested_at", "published_at", "title", "description", "source_name", "search_query", "source", "date"],
        lambda df: df.select(*SV.SCORED_NEWS_COLUMNS),
    ),
    "fred": Source(
        schemas.RAW_MACRO, SV.clean_macro, ["series_name", "date"],
        ["ingested_at", "series_id", "value", "frequency", "source"],
        lambda df: SV.macro_ffill(df, SV.series_found(df)),
    ),
}


def start_ingest(spark: SparkSession, source: str, bronze_path: str, increments_path: str, checkpoint_path: str,
                 available_now: bool = True) -> StreamingQuery:
    """Start the incremental cleaning of one landing folder (stocks, news or fred)."""
    src = SOURCES[source]
    raw = spark.readStream.schema(src.raw_schema).json(bronze_path)
    target = increments_path.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per micro-batch, overwritten on a retry: a batch that is
        # re-run after a failure replaces its own output instead of adding to it.
        src.clean(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def silver_view(spark: SparkSession, source: str, increments_path: str) -> DataFrame:
    """The silver table over all increments: latest ingestion per key, then finished."""
    src = SOURCES[source]
    inc = spark.read.parquet(increments_path).drop("batch_id")
    return src.finish(dedup_latest(inc, src.keys, src.order))
