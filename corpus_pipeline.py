"""The corpus pipeline: documents through five stages, each written and read again.

1. quality rules: documents that the rules reject go;
2. line dedup: later copies of repeated line runs go, documents stay;
3. near duplicates (five-word shingles, similarity 0.8): one document of each group stays;
4. benchmark decontamination: documents that hold a benchmark passage go;
5. mixing: how many words of each document the mix takes, by source targets.

A stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; rows with a null doc_id are judged by their text where a stage
can, and kept otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, linededup, mixing, neardup, quality
from tidewatch.llm.common import fenced
from tidewatch.operators.joins import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return fenced(judged, F.col("_kept")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, neardup.near_duplicates(docs).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, decontaminate.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs


# The quality stage is learned from labels, which SQL cannot express.
ORACLE_SQL = None
