"""Published tables: readers see whole versions, manifests describe them, reads of few keys open few files."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewatch.operators import sentiment as SN
from tidewatch.operators import silver as SV
from tidewatch.plans import batch as P
from tidewatch.plans.layers import Layers
from tidewatch.sources import publish as PB
from tidewatch.sources import schemas
from tidewatch.sources import storage as io


def frame(spark, n, tickers=40, shift=0):
    return spark.range(n).select((F.col("id") % tickers).cast("string").alias("ticker"),
                                 F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / tickers).cast("int")).alias("date"),
                                 (F.col("id") + shift).alias("v"))


def tickers(df):
    """Rows of each ticker, by one read per ticker, as a wrong bucket count would lose rows of such reads only."""
    return {str(t): df.where(F.col("ticker") == str(t)).count() for t in range(40)}


def test_a_writer_killed_before_the_mark_leaves_the_old_table_whole(spark, tmp_root, monkeypatch):
    path, table = f"file://{tmp_root}/gold/t", "tw_test_killed"
    assert io.write_bucketed(frame(spark, 1000), path, table, 16) == 1000
    want = {str(t): 25 for t in range(40)}
    assert tickers(io.bucketed_table(spark, table, path)) == want

    for broken in ("_described", "_create"):  # after the data; after the manifest, at the mark
        with monkeypatch.context() as m:
            true = getattr(PB, broken)

            def dies(*args):
                if broken == "_create" and "_published" not in args[1]:
                    return true(*args)
                raise KeyboardInterrupt

            m.setattr(PB, broken, dies)
            with pytest.raises(KeyboardInterrupt):
                io.write_bucketed(frame(spark, 2000), path, table, 4)
        assert tickers(io.bucketed_table(spark, table, path)) == want and io.bucket_count(spark, path) == 16
        spark.sql(f"DROP TABLE {table}")  # as in a new process
        assert tickers(io.bucketed_table(spark, table, path)) == want

    assert io.write_bucketed(frame(spark, 2000), path, table, 4) == 2000
    assert tickers(io.bucketed_table(spark, table, path)) == {str(t): 50 for t in range(40)} and io.bucket_count(spark, path) == 4
    listed = io.register_database(spark, "tw_test_published", {"t": path})
    assert listed.count() == 1 and tickers(spark.table("tw_test_published.t")) == {str(t): 50 for t in range(40)}
    spark.sql("DROP DATABASE tw_test_published CASCADE")
    spark.sql(f"DROP TABLE {table}")


def test_a_writer_that_fails_in_the_data_leaves_the_old_table(spark, tmp_root):
    path = f"file://{tmp_root}/t"
    PB.publish(spark, path, frame(spark, 100).write.parquet)
    bad = frame(spark, 100).withColumn("v", F.when(F.col("v") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        PB.publish(spark, path, bad.write.parquet)
    assert io.read_table(spark, path).count() == 100


def test_a_reader_of_the_last_version_can_finish(spark, tmp_root):
    path = f"file://{tmp_root}/t"
    PB.publish(spark, path, frame(spark, 100).write.parquet)
    reader = io.read_table(spark, path)
    PB.publish(spark, path, frame(spark, 200).write.parquet)
    assert reader.count() == 100 and io.read_table(spark, path).count() == 200
    PB.publish(spark, path, frame(spark, 300).write.parquet)
    assert len(os.listdir(f"{tmp_root}/t/versions")) == PB.KEEP and io.read_table(spark, path).count() == 300
    # A table can be rewritten from itself.
    PB.publish(spark, path, io.read_table(spark, path).where("v < 50").write.parquet)
    assert io.read_table(spark, path).count() == 50


def test_two_writers_claim_different_numbers(spark, tmp_root):
    path = f"file://{tmp_root}/t"

    def slow(folder):
        PB.publish(spark, path, frame(spark, 200).write.parquet)  # another writer, begun later and done earlier
        frame(spark, 100).write.parquet(folder)

    PB.publish(spark, path, slow)
    assert io.read_table(spark, path).count() == 200


def test_manifest_totals_and_empty_tables(spark, tmp_root):
    path = f"file://{tmp_root}/t"
    PB.publish(spark, path, lambda f: io.write_clustered(frame(spark, 1000), f))
    whole, files = PB.totals(spark, path), PB.manifest(spark, path).where("file is not null").collect()
    assert (whole.rows, whole.first_date, whole.last_date) == (1000, "2024-01-01", "2024-01-25")
    assert sum(f.rows for f in files) == 1000
    on_disk = {n: os.path.getsize(f"{tmp_root}/t/versions/{PB.version(spark, path)}/{n}") for n in (f.file for f in files)}
    assert {f.file: f.bytes for f in files} == on_disk
    assert PB.publish(spark, path, frame(spark, 0).write.parquet) == 0 and io.read_table(spark, path).count() == 0
    assert PB.version(spark, f"{path}/none") is None and PB.manifest(spark, f"{path}/none") is None


def test_reads_of_a_date_range_open_the_files_that_hold_it(spark, tmp_root):
    path = f"file://{tmp_root}/t"
    PB.publish(spark, path, lambda f: frame(spark, 1000).repartitionByRange(10, "date").write.parquet(f))
    last = PB.totals(spark, path).last_date
    files = PB.files_between(spark, path, "date", last, last)
    assert len(files) == 1
    got = PB.read_between(spark, path, "date", "2024-01-10", "2024-01-12")
    assert len(got.inputFiles()) < 5 and sorted(map(tuple, got.collect())) == sorted(
        map(tuple, frame(spark, 1000).where("date between '2024-01-10' and '2024-01-12'").collect()))
    assert PB.read_between(spark, path, "date", "2030-01-01", "2030-01-02").count() == 0


def test_inventory_shows_a_lost_file(spark, tmp_root):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    counts = P.RowCounts()
    P.run(spark, root, counts=counts)
    found = {(r.layer, r.table): r for r in io.checked_inventory(spark, root).collect()}
    assert len(found) == 9 and all(r.passed and r.bytes > 0 for r in found.values())
    written = {k: n for k, n in counts.result().items() if not k.startswith("bronze")}
    assert written == {f"{x}.{y}": r.row_count for (x, y), r in found.items() if y != "quality_report"}
    assert written["silver.stocks"] == L.silver_stocks.count()
    files = {(r.layer, r.table): r for r in io.layer_inventory(spark, root).collect()}
    assert all(files[k].bytes >= r.bytes for k, r in found.items())
    # Published once more, the inventory still counts one version.
    P.run(spark, root, from_step="marts")
    assert {(r.layer, r.table): r.files for r in io.layer_inventory(spark, root).collect()} == {k: r.files for k, r in files.items()}
    folder = PB.location(spark, f"{root}/silver/news").removeprefix("file://")
    lost = next(n for n in os.listdir(folder) if n.endswith(".parquet") and os.path.getsize(f"{folder}/{n}") > 2000)
    shutil.move(f"{folder}/{lost}", f"{tmp_root}/{lost}")
    bad = [r for r in io.checked_inventory(spark, root).collect() if not r.passed]
    assert [(r.table, r.failed_files) for r in bad] == [("news", 1)]


def test_ordered_tables_hold_consecutive_ranges(spark, tmp_root):
    L = Layers.from_testdata(spark, SF_SMALL)
    path = f"file://{tmp_root}/news"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        PB.publish(spark, path, lambda f: io.write_ordered(L.news_clean.where("date is not null"), f, ["date", "url"], SN.score_news))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((f.first_date, f.last_date) for f in PB.manifest(spark, path).where("file is not null").collect())
    assert len(files) >= 4 and all(a[1] <= b[0] for a, b in zip(files, files[1:]))
    day = files[0][0]
    assert len(PB.files_between(spark, path, "date", day, day)) < len(files) / 2
    want = L.news_sentiment.where(F.col("date") == F.lit(day).cast("date"))
    got = PB.read_between(spark, path, "date", day, day).select(want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_a_seventh_series_is_kept_and_told(spark, tmp_root):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    seventh = L.raw_macro.where("series_id = 'DFF'").withColumns({"series_id": F.lit("GOLD"), "series_name": F.lit("gold`s price")})
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro.unionByName(seventh))
    listing = {r.table_name: r.row_count for r in P.run(spark, root).collect()}  # no check fails
    macro = io.read_table(spark, f"{root}/silver/fred")
    assert macro.columns[1:] == [*SV.SERIES_NAMES, "gold`s price"]
    assert macro.where("not (`gold``s price` <=> federal_funds_rate)").count() == 0
    assert macro.select("date", *SV.SERIES_NAMES).exceptAll(L.macro_ffill).count() == 0
    told = io.read_table(spark, f"{root}/marts/quality_report").where("test_name = 'unknown_series'").collect()
    assert [(r.column_name, r.passed) for r in told] == [("gold`s price", True)] and told[0].failures > 0
    assert listing["fct_market_signals"] == L.signals.count()
    with pytest.raises(ValueError, match="clashes"):
        SV.series_found(L.raw_macro.withColumn("series_name", F.lit("Date")))


def test_bronze_counts_are_exact_with_broken_records(spark, tmp_root):
    counts = P.RowCounts()
    path = f"{tmp_root}/r"
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('{"series_id": "DFF", "value": 1.0}\n{"series_id": \n{"series_id": "DFF", "value": "x"}\n')
    counts.count_raw("bronze.fred", io.read_raw_json(spark, f"file://{path}", schemas.RAW_MACRO, with_corrupt=True))
    assert counts.result() == {"bronze.fred": 3} and counts.corrupt() == {"bronze.fred": 2}
