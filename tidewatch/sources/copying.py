"""Copies of finished layers under another root, file by file, with totals.

Every data file of a table is read by one task and written as one file, in the
order of its rows, so sorted and ranged tables stay so and nothing is shuffled.
Bucketed tables are read and written by bucket. A published table is copied as
the version that readers open when the copy begins, and becomes a new
published version of the target: readers there see the old copy or the new one.
Bronze folders are copied line by line. Hidden and ``_`` files are left out, as
Spark lists none of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources import publish as PB
from tidewatch.sources import storage as io

# Larger than any file: a file is neither split nor read with another one.
_WHOLE_FILE = 1 << 40
_REPORT = "layer string, table string, files long, bytes long, row_count long, source_rows long, passed boolean"


def _by_file(spark: SparkSession) -> SparkSession:
    """A session of its own settings: a task per file, partition columns as they stand in the path."""
    own = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{key}", str(_WHOLE_FILE))
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return own


def _partition_columns(spark: SparkSession, path: str, version: str) -> list[str]:
    """The columns that the version's folders are partitioned by, from one file name of its manifest."""
    named = PB.manifest(spark, path, version).where("file is not null").select("file").first()
    return [] if named is None else [p.partition("=")[0] for p in named["file"].split("/")[:-1] if "=" in p]


def copy_table(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """Copy the published table at ``source`` to ``target``; returns the rows of both."""
    version = PB.version(spark, source)
    if version is None:
        raise ValueError(f"{source} is not published")
    whole = PB.totals(spark, source, version)
    rows = int(whole["rows"]) if whole is not None else 0
    if whole is not None and whole["buckets"] is not None:
        name = f"tw_copying_{uuid.uuid4().hex}"
        try:
            return rows, io.write_bucketed(io.bucketed_table(spark, name, source), target, f"{name}_to", whole["buckets"])
        finally:
            for table in (name, f"{name}_to"):
                spark.sql(f"DROP TABLE IF EXISTS {table}")  # external tables: the files stay
    folder, by = f"{source.rstrip('/')}/versions/{version}", _partition_columns(spark, source, version)

    def write(to: str) -> None:
        writer = _by_file(spark).read.parquet(folder).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(to)

    return rows, PB.publish(spark, target, write)


def copy_lines(spark: SparkSession, source: str, target: str) -> tuple[int, int]:
    """Copy text files (landed JSON of any form) to ``target``, replacing what it holds; returns the lines of both."""
    reader = _by_file(spark).read.option("recursiveFileLookup", "true")
    reader.text(source).write.mode("overwrite").option("lineSep", "\n").text(target)
    return tuple(spark.read.option("recursiveFileLookup", "true").text(x).count() for x in (source, target))


def copy_layers(spark: SparkSession, root: str, target: str, layers: Iterable[str] = ("bronze", "silver", "gold", "marts")) -> DataFrame:
    """Copy the tables of ``layers`` under ``root`` to the same places under ``target``.

    Returns a row per table: files and bytes found at the target, its rows,
    the source's, and whether the copy is whole. An absent layer has no rows.
    Only names and totals reach the driver.
    """
    root, target = root.rstrip("/"), target.rstrip("/")
    if f"{target}/".startswith(f"{root}/") or f"{root}/".startswith(f"{target}/"):
        raise ValueError("a layer is not copied into itself")
    counts = {}
    for layer in layers:
        published = PB.published_tables(spark, f"{root}/{layer}")
        for table in (n for n in PB._names(spark, f"{root}/{layer}") if n[0] not in "._"):
            copy = copy_table if table in published else copy_lines
            counts[layer, table] = copy(spark, f"{root}/{layer}/{table}", f"{target}/{layer}/{table}")
    if not counts:
        return spark.createDataFrame([], _REPORT)
    rows = spark.createDataFrame([(*k, *v) for k, v in counts.items()], "layer string, table string, source_rows long, row_count long")
    found = io.layer_inventory(spark, target)
    failed = io.checked_inventory(spark, target, [x for x in layers if x != "bronze"])
    out = rows.join(found, ["layer", "table"], "left")
    out = out.withColumn("failed_files", F.lit(0)) if failed is None else out.join(
        failed.select("layer", "table", "failed_files"), ["layer", "table"], "left")
    passed = (F.col("row_count") == F.col("source_rows")) & (F.coalesce("failed_files", F.lit(0)) == 0)
    return out.select("layer", "table", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"),
                      "row_count", "source_rows", passed.alias("passed"))
