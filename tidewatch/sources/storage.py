"""Readers and writers for the layer folders, and the layer inventory.

Every path is a URI under a root the caller gives (a lake path such as
``abfss://…`` on a cluster), so each step writes straight to its target;
nothing is staged on a machine-local disk and copied afterwards.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.exprs import quoted
from tidewatch.sources import publish as PB
from tidewatch.sources.landed import CORRUPT, read_landed_json


# --- sources -----------------------------------------------------------------

def read_raw_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | None = False,
                  with_corrupt: bool = False) -> DataFrame:
    """Raw JSON records with an explicit schema (no inference pass).

    ``multi_line=True`` reads files that each hold one JSON array (the
    extractors' format); the default reads newline-delimited JSON, which
    splits across tasks; ``multi_line=None`` reads any mix of forms
    (``sources.landed``). Folders below ``path``, such as those of intake
    plans, are read too. ``with_corrupt=True`` adds the text of records that
    cannot be parsed as ``_corrupt_record``, so the caller can count them.
    """
    if multi_line is None:
        return read_landed_json(spark, path, schema, with_corrupt)
    reader = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", "true")
    if with_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table, published or plain; with a schema, partition columns keep their declared type."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(PB.location(spark, path))


# --- sinks -------------------------------------------------------------------
# Upper bound of rows per output file, so one large task writes several
# files instead of one very large one.
MAX_RECORDS_PER_FILE = 5_000_000

# Ranges per core of a partitioned write, so that cores which finish early get more.
RANGES_PER_CORE = 4


def _write_tasks(spark: SparkSession) -> int:
    """Ranges of a partitioned write: the session's shuffle partitions, and several for each core if there are more."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # a remote (Connect) session has no SparkContext
        cores = 1
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), RANGES_PER_CORE * cores)


def append_json(df: DataFrame, path: str) -> None:
    """Append newline-delimited JSON files (one landing batch) under ``path``."""
    df.write.mode("append").json(path)


def write_partitioned(df: DataFrame, path: str, by: str = "ticker", order: str = "date",
                      after_exchange: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Overwrite Parquet partitioned by ``by``, rows sorted by ``order`` within files.

    Range partitioning on (by, order) bounds the files per folder (a key
    spans few tasks) and splits a very large key across tasks instead of
    sending it to one. No global sort is needed: readers order at read time.
    The ranges have a given number: making a file per key costs far more than
    its bytes, and adaptive execution would merge ranges by bytes alone, into
    about a task a core, where one late task leaves the other cores idle.
    ``after_exchange`` is applied above the range exchange, so it runs only
    in the write job and not in the sampling job that finds the ranges.
    """
    ranged = df.repartitionByRange(_write_tasks(df.sparkSession), F.col(by), F.col(order))
    if after_exchange is not None:
        ranged = after_exchange(ranged)
    (
        ranged.sortWithinPartitions(by, order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(by)
        .parquet(path)
    )


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def write_ordered(df: DataFrame, path: str, by: Iterable[str | Column],
                  after_exchange: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Overwrite flat Parquet in the order ``by``: files hold consecutive ranges, rows are sorted inside.

    Ranges are over all of ``by``, so one frequent leading value spans several
    files, and a filter on the leading column opens few files and row groups.
    ``after_exchange`` is applied above the range exchange, so it runs only in
    the write job and not in the sampling job that finds the ranges.
    """
    by = list(by)
    ranged = df.repartitionByRange(*by)
    if after_exchange is not None:
        ranged = after_exchange(ranged)
    write_flat(ranged.sortWithinPartitions(*by), path)


def write_clustered(df: DataFrame, path: str, by: str = "ticker", order: str = "date") -> None:
    """Overwrite flat Parquet with rows sorted by (by, order) inside each file.

    Keeps the partitioning the plan already has (after a window by ``by`` the
    rows are hash-clustered by it), so no shuffle is added; the sort is local
    and usually already satisfied. Row-group min/max statistics on ``by``
    let a reader skip groups for a one-key filter, without one folder (and
    at least one file) per key.
    """
    (
        df.sortWithinPartitions(by, order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, path: str, table: str, buckets: int, by: str = "ticker",
                   order: str = "date") -> int:
    """Publish a Parquet table at ``path`` bucketed by ``by`` into ``buckets``, sorted by (by, order),
    and declare it as ``table`` in the session catalog; returns its rows.

    Readers of the table that group or window by ``by`` reuse the bucketing
    instead of shuffling. Rows are hash-partitioned into the bucket count
    first (a no-op when the plan already has that partitioning), so each
    task writes one file per bucket rather than one per bucket it happens to see.
    The bucket count is part of the version's manifest, so data and count
    become visible together.
    """
    spark = df.sparkSession

    def write(folder: str) -> None:
        name = f"tw_writing_{uuid.uuid4().hex}"  # Spark buckets only what it saves as a table
        try:
            (
                df.repartition(buckets, F.col(by))
                .write.format("parquet")
                .bucketBy(buckets, by)
                .sortBy(by, order)
                .option("path", folder)
                .saveAsTable(name)
            )
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: the files stay

    rows = PB.publish(spark, path, write, buckets)
    bucketed_table(spark, table, path, by, order)
    return rows


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The bucket count that the published table at ``path`` was written with, if it has one."""
    whole = PB.totals(spark, path)
    return None if whole is None else whole["buckets"]


def bucketed_table(spark: SparkSession, table: str, path: str, by: str = "ticker", order: str = "date") -> DataFrame:
    """The bucketed table ``table`` over the published version at ``path``.

    A session that does not know the table, or knows it over another version
    or with another bucket count, declares it with the count of the manifest:
    with any other count Spark would skip files or look for keys in the wrong
    ones. Files without a known count are read as plain Parquet.
    """
    written, folder = bucket_count(spark, path), PB.location(spark, path)
    if written is None:
        return spark.read.parquet(folder)
    if spark.catalog.tableExists(table):
        facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name in ('Num Buckets', 'Location')").collect()}
        if facts.get("Num Buckets") == str(written) and _plain(facts.get("Location", "")) == _plain(folder):
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
    fields = spark.read.parquet(folder).schema.fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{by}`) "
        f"SORTED BY (`{by}`, `{order}`) INTO {written} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(table)


def _plain(uri: str) -> str:
    """A location without the spelling differences of its scheme (file:/x, file:///x, /x)."""
    return re.sub(r"^file:/*", "/", uri.rstrip("/"))


# --- tables ------------------------------------------------------------------
def register_tables(spark: SparkSession, root: str, names: Iterable[str]) -> list[str]:
    """Register each ``root/name`` Parquet folder as a view ``name``; skip absent ones."""
    done = []
    for name in names:
        try:
            df = read_table(spark, f"{root.rstrip('/')}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                continue
            raise
        df.createOrReplaceTempView(name)
        done.append(name)
    return done


def register_database(spark: SparkSession, database: str, paths: dict[str, str]) -> DataFrame:
    """Keep the Parquet tables at ``paths`` (name to URI) in a catalog database; lists all its tables.

    The tables are external: the catalog keeps names and locations, and a
    table that is named again is declared anew over its files. Bucketed files
    are declared with the bucket count kept beside them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in paths.items():
        table = f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        if bucket_count(spark, path) is not None:
            bucketed_table(spark, table, path)
            continue
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{PB.location(spark, path)}'")
        if spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = '# Partition Information'").count():
            spark.catalog.recoverPartitions(table)
    return spark.sql(f"SHOW TABLES IN `{database}`").where("not isTemporary").select(F.col("namespace").alias("database_name"), F.col("tableName").alias("table_name"))


def table_listing(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Registered tables with row and column counts."""
    out = None
    for name in names:
        df = spark.table(name)
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("long").alias("column_count")
        )
        out = part if out is None else out.unionByName(part)
    return out


def column_listing(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Columns of registered tables: place, name, type and number of values; one pass per table."""
    out = None
    for name in names:
        df = spark.table(name)
        columns = F.array(*(F.struct(
            F.lit(i).cast("long").alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.count(F.col(quoted(f.name))).alias("value_count"))
            for i, f in enumerate(df.schema.fields, 1)))
        part = df.agg(columns.alias("c")).select(F.lit(name).alias("table_name"), F.inline("c"))
        out = part if out is None else out.unionByName(part)
    return out


def layer_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per (layer, table) under ``root/<layer>/<table>/…``.

    Reads only file metadata: the binary source prunes the content column
    when just path and length are selected. Names starting with ``.`` or
    ``_`` are skipped by Spark's listing. Of a published table only the
    version counts that readers open.
    """
    base = root.rstrip("/")
    found = _inventory_files(spark, base)
    tables = [(r.layer, r.table) for r in found.where("version is not null").select("layer", "table").distinct().collect()]
    current = [F.struct(F.lit(x).alias("layer"), F.lit(y).alias("table"), F.lit(PB.version(spark, f"{base}/{x}/{y}")).alias("version")) for x, y in tables]
    counted = F.col("version").isNull()
    for c in current:
        counted |= F.struct("layer", "table", "version") == c
    return found.where(counted).groupBy("layer", "table").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _inventory_files(spark: SparkSession, base: str) -> DataFrame:
    """layer, table, version (NULL if plain) and length of every data file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length")
    )
    layer_path = r"^.*?/(bronze|silver|gold|marts)/(.*)$"
    parts = F.split(F.regexp_extract(F.col("path"), layer_path, 2), "/")
    return files.select(
        F.regexp_extract(F.col("path"), layer_path, 1).alias("layer"),
        F.element_at(parts, 1).alias("table"),
        F.when(F.get(parts, F.lit(1)) == "versions", F.get(parts, F.lit(2))).alias("version"),
        "length",
    ).where(F.col("layer") != "")


def checked_inventory(spark: SparkSession, root: str, layers: Iterable[str] = ("silver", "gold", "marts")) -> DataFrame:
    """Per published table under ``root``: files, bytes and rows of its manifest, files that are gone or of another
    length, and whether all are there."""
    out = None
    for layer in layers:
        for table in PB.published_tables(spark, f"{root.rstrip('/')}/{layer}"):
            part = PB.checked_files(spark, f"{root.rstrip('/')}/{layer}/{table}").agg(
                F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
                F.count_if(~F.col("passed")).alias("failed_files")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table"), "files", "bytes", "row_count", "failed_files",
                (F.col("failed_files") == 0).alias("passed"))
            out = part if out is None else out.unionByName(part)
    return out
