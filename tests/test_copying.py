"""Copied layers: the same rows, files and layouts under another root, whole or told to be broken."""

import os

import pytest
from pyspark.sql import functions as F

from tests.test_publish import frame, tickers
from tidewatch.sources import publish as PB
from tidewatch.sources import storage as io
from tidewatch.sources.copying import copy_layers, copy_table


def lake(spark, root):
    """Tables of every layout, and landed lines."""
    df = frame(spark, 2000)
    io.write_bucketed(df, f"{root}/gold/bucketed", "tw_test_copied", 8)
    PB.publish(spark, f"{root}/silver/ordered", lambda to: io.write_ordered(df.repartition(7), to, ["date", "ticker"]))
    odd = df.withColumn("ticker", F.element_at(F.array(*map(F.lit, ["007", "TRUE", "1e5", "A B/C"])), (F.col("v") % 4 + 1).cast("int")))
    PB.publish(spark, f"{root}/marts/by_ticker", lambda to: io.write_partitioned(odd, to))
    PB.publish(spark, f"{root}/marts/empty", lambda to: io.write_flat(df.limit(0), to))
    spark.range(500).select(F.to_json(F.struct("id")).alias("value")).write.text(f"{root}/bronze/news/one")
    spark.createDataFrame([("[\n{\"id\": 1},\n {\"id\": 2}\n]",)], "value string").write.text(f"{root}/bronze/news/two")


def described(spark, path):
    """Rows and key ranges of each data file, whatever its name."""
    columns = ["rows", "buckets", "first_date", "last_date", "first_ticker", "last_ticker"]
    return sorted(map(str, PB.manifest(spark, path).where("file is not null").select(*columns).collect()))


def test_copied_tables_have_the_same_rows_files_and_layout(spark, tmp_root):
    root, target = f"file://{tmp_root}/lake", f"file://{tmp_root}/copy"
    lake(spark, root)
    report = {(r.layer, r.table): r for r in copy_layers(spark, root, target).collect()}
    assert set(report) == {("bronze", "news"), ("silver", "ordered"), ("gold", "bucketed"), ("marts", "by_ticker"), ("marts", "empty")}
    assert all(r.passed and r.files > 0 and r.bytes > 0 and r.row_count == r.source_rows for r in report.values())
    assert report["bronze", "news"].row_count == 504 and report["marts", "empty"].row_count == 0
    for table in ("silver/ordered", "marts/by_ticker", "marts/empty", "gold/bucketed"):
        want, got = (io.read_table(spark, f"{x}/{table}") for x in (root, target))
        assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
        assert described(spark, f"{root}/{table}") == described(spark, f"{target}/{table}")
    assert tickers(io.bucketed_table(spark, "tw_test_copy", f"{target}/gold/bucketed")) == {str(t): 50 for t in range(40)}
    spark.sql("DROP TABLE tw_test_copy")
    odd = PB.read_between(spark, f"{target}/marts/by_ticker", "ticker", "A", "B")
    assert odd.count() == 500 and odd.select("ticker").distinct().collect() == [("A B/C",)]
    # Arrays over several lines are still arrays.
    ids = io.read_raw_json(spark, f"{target}/bronze/news", spark.range(1).schema, multi_line=None)
    assert sorted(r.id for r in ids.collect()) == sorted([*range(500), 1, 2])


def test_a_copy_is_replaced_as_a_whole_and_broken_files_are_told(spark, tmp_root):
    root, target = f"file://{tmp_root}/lake", f"file://{tmp_root}/copy"
    PB.publish(spark, f"{root}/gold/t", lambda to: io.write_flat(frame(spark, 400), to))
    copy_layers(spark, root, target, ["gold"])
    old = io.read_table(spark, f"{target}/gold/t")
    PB.publish(spark, f"{root}/gold/t", lambda to: io.write_flat(frame(spark, 300, shift=9), to))
    assert copy_layers(spark, root, target, ["gold"]).collect()[0].row_count == 300
    assert old.count() == 400  # who reads the copy before can finish
    folder = PB.location(spark, f"{target}/gold/t").removeprefix("file://")
    os.remove(next(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")))
    assert not io.checked_inventory(spark, target).collect()[0].passed


def test_what_cannot_be_copied(spark, tmp_root):
    root = f"file://{tmp_root}/lake"
    assert copy_layers(spark, root, f"file://{tmp_root}/copy").collect() == []
    for target in (root, f"{root}/inside"):
        with pytest.raises(ValueError, match="itself"):
            copy_layers(spark, root, target)
    with pytest.raises(ValueError, match="not published"):
        copy_table(spark, f"{root}/gold/none", f"file://{tmp_root}/copy/gold/none")
