"""Tables that switch as a whole.

A published table keeps its data in numbered version folders, and beside each
version a manifest. An empty mark file, made last, names the version that
readers open, so a writer that dies at any point leaves the table as it was:

  <table>/versions/0000000003/part-….parquet   data, never changed afterwards
  <table>/_manifests/0000000003/…              files, rows, bytes, key ranges, bucket count
  <table>/_published/0000000003                the mark; the greatest one counts
  <table>/_claims/0000000003                   numbers are claimed by exclusive creation

Creating an empty file is atomic on every file system Spark writes to, so the
switch needs no rename. Two writers at once claim different numbers; both
versions are whole and the greater number wins. The driver lists marks and
claims only (a few names per table); data files are described by a Spark job
over the key columns of what was written.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Published versions that stay, so that a reader of the last one can finish.
KEEP = 2
# A version that was never published is taken for abandoned after this long.
STALE_HOURS = 24

# Columns whose range in each file is kept, where a table has them.
RANGED = ("date", "ticker")
MANIFEST = ("file string, rows long, bytes long, buckets int, first_date string, last_date string, "
            "first_ticker string, last_ticker string")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _create(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already."""
    fs, p = _fs(spark, path)
    try:
        return bool(fs.createNewFile(p))
    except Exception as e:  # some stores answer with an error
        if "AlreadyExists" in str(e):
            return False
        raise


def _claim(spark: SparkSession, path: str) -> str:
    known = [int(n) for n in _names(spark, f"{path}/_claims") if n.isdigit()]
    n = max(known, default=0) + 1
    while not _create(spark, f"{path}/_claims/{n:010d}"):
        n += 1
    return f"{n:010d}"


def version(spark: SparkSession, path: str) -> str | None:
    """The published version of the table at ``path``, or None if it never was published."""
    marks = [n for n in _names(spark, f"{path.rstrip('/')}/_published") if n.isdigit()]
    return marks[-1] if marks else None


def location(spark: SparkSession, path: str) -> str:
    """The folder that readers of ``path`` open: the published version, or ``path`` itself."""
    path = path.rstrip("/")
    found = version(spark, path)
    return path if found is None else f"{path}/versions/{found}"


def published_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published tables right below ``folder``."""
    return [n for n in _names(spark, folder) if version(spark, f"{folder}/{n}") is not None]


def manifest(spark: SparkSession, path: str, of: str | None = None) -> DataFrame | None:
    """One row per data file of the published (or given) version, and one with a NULL file for the whole."""
    path = path.rstrip("/")
    found = of or version(spark, path)
    return None if found is None else spark.read.schema(MANIFEST).json(f"{path}/_manifests/{found}")


def totals(spark: SparkSession, path: str, of: str | None = None):
    """The manifest's row for the whole table (rows, bytes, buckets, ranges), or None."""
    found = manifest(spark, path, of)
    return None if found is None else found.where("file is null").first()


def _key(column: str):
    """The column as text; a partition column as it stands in the path, before any type is guessed for it."""
    own = F.regexp_extract(F.col("_metadata.file_path"), f"/{column}=([^/]*)/", 1)
    return F.when(own != "", own).otherwise(F.col(column).cast("string"))


def _described(spark: SparkSession, folder: str, buckets: int | None) -> DataFrame:
    """The manifest of the data in ``folder``: one pass over its key columns."""
    stored = spark.read.parquet(folder)
    name = folder.rstrip("/").rpartition("/")[2]
    ranged = [c for c in RANGED if c in stored.columns]
    keys = stored.select(
        F.regexp_extract(F.col("_metadata.file_path"), f"/versions/{name}/(.*)$", 1).alias("file"),
        F.col("_metadata.file_size").alias("size"), *(_key(c).alias(c) for c in ranged))
    ranges = [f(F.col(c)).alias(f"{n}_{c}") for c in ranged for f, n in ((F.min, "first"), (F.max, "last"))]
    files = keys.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"), *ranges)
    whole = [f(F.col(f"{n}_{c}")).alias(f"{n}_{c}") for c in ranged for f, n in ((F.min, "first"), (F.max, "last"))]
    missing = [F.lit(None).cast("string").alias(f"{n}_{c}") for c in RANGED if c not in ranged for n in ("first", "last")]
    columns = [c.split()[0] for c in MANIFEST.split(", ")]
    bucket = F.lit(buckets).cast("int").alias("buckets")
    # The total is taken from the same rows: a grouping set, not a second scan.
    return files.rollup("file").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), *whole, F.grouping("file").alias("g")).select(
        F.when(F.col("g") == 0, F.col("file")).alias("file"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"), bucket, *[f"{n}_{c}" for c in ranged for n in ("first", "last")], *missing).select(*columns)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], buckets: int | None = None, keep: int = KEEP) -> int:
    """Write a new version with ``write(folder)``, describe it, then make it the one that is read; returns its rows.

    Until the last statement readers see the version before. A failed or killed
    publication leaves a folder that nothing names; a later one removes it.
    """
    path = path.rstrip("/")
    name = _claim(spark, path)
    folder = f"{path}/versions/{name}"
    write(folder)
    _described(spark, folder, buckets).coalesce(1).write.json(f"{path}/_manifests/{name}")
    whole = totals(spark, path, name)
    _create(spark, f"{path}/_published/{name}")
    expire(spark, path, keep)
    return int(whole["rows"]) if whole is not None else 0


def expire(spark: SparkSession, path: str, keep: int = KEEP, stale_hours: float = STALE_HOURS) -> list[str]:
    """Remove all but the last ``keep`` published versions, and abandoned ones; returns their names."""
    path = path.rstrip("/")
    published = [n for n in _names(spark, f"{path}/_published") if n.isdigit()]
    old = published[:-keep] if keep else []
    fs, _ = _fs(spark, path)
    for name in _names(spark, f"{path}/versions"):
        _, p = _fs(spark, f"{path}/versions/{name}")
        if name not in published and (time.time() - fs.getFileStatus(p).getModificationTime() / 1000) > stale_hours * 3600:
            old.append(name)
    for name in old:
        # The mark goes first: what is half removed is not named any more.
        for folder in ("_published", "versions", "_manifests"):
            _, p = _fs(spark, f"{path}/{folder}/{name}")
            fs.delete(p, True)
    return old


def files_between(spark: SparkSession, path: str, column: str, low: str, high: str) -> list[str]:
    """The published files whose range of ``column`` meets ``low`` to ``high`` (compared as text)."""
    found = manifest(spark, path)
    if found is None:
        raise ValueError(f"{path} is not published")
    rows = found.where("file is not null").where((F.col(f"last_{column}") >= low) & (F.col(f"first_{column}") <= high)).select("file")
    base = location(spark, path)
    return [f"{base}/{unquote(r.file)}" for r in rows.collect()]  # the manifest has names as URIs


def read_between(spark: SparkSession, path: str, column: str, low: str, high: str) -> DataFrame:
    """Rows of the published table with ``column`` in ``low`` to ``high``; other files are not opened."""
    files = files_between(spark, path, column, low, high)
    base = location(spark, path)
    whole = spark.read.parquet(base)
    if not files:
        return whole.limit(0)
    rows = spark.read.option("basePath", base).schema(whole.schema).parquet(*files)
    kind = dict(whole.dtypes)[column]
    return rows.where(F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def checked_files(spark: SparkSession, path: str) -> DataFrame:
    """Per file of the published version: rows and bytes of the manifest, bytes found, and whether they agree."""
    base = location(spark, path)
    name = base.rpartition("/")[2]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select(
        F.regexp_extract(F.col("_metadata.file_path"), f"/versions/{name}/(.*)$", 1).alias("file"), F.col("length").alias("found_bytes"))
    named = manifest(spark, path).where("file is not null").select("file", "rows", "bytes")
    return named.join(found, "file", "left").withColumn("passed", F.coalesce(F.col("bytes") == F.col("found_bytes"), F.lit(False)))
