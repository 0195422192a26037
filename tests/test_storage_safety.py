"""A resumed batch reads every row whatever the bucket count; landed arrays and bad records are seen."""

import json
import types

import pytest
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.plans import batch
from tidewatch.plans.layers import Layers
from tidewatch.sources import fixtures, schemas
from tidewatch.sources import storage as io

SF = "/root/testdata/sf0.001"


def test_bucketed_table_is_declared_with_the_count_it_was_written_with(spark, tmp_root):
    df = spark.range(1000).select((F.col("id") % 40).cast("string").alias("ticker"), F.col("id").alias("date"))
    path = f"{tmp_root}/gold/t"
    io.write_bucketed(df, path, "tw_test_buckets", 16)
    want = sorted(map(tuple, df.groupBy("ticker").count().collect()))
    spark.sql("DROP TABLE tw_test_buckets")  # as in a new process
    again = io.bucketed_table(spark, "tw_test_buckets", path)
    assert sorted(map(tuple, again.groupBy("ticker").count().collect())) == want
    assert again.where("ticker = '7'").count() == 25
    # Rewritten with another count by another name: the declared table follows the files.
    io.write_bucketed(df, path, "tw_test_buckets_2", 4)
    assert sorted(map(tuple, io.bucketed_table(spark, "tw_test_buckets", path).groupBy("ticker").count().collect())) == want
    assert io.bucket_count(spark, path) == 4 and io.bucket_count(spark, f"{tmp_root}/gold/none") is None
    spark.sql("DROP TABLE IF EXISTS tw_test_buckets")
    spark.sql("DROP TABLE IF EXISTS tw_test_buckets_2")


def test_bucketed_resume_keeps_all_tickers(spark, tmp_root):
    L = Layers.from_testdata(spark, SF)
    batch.land(tmp_root, L.raw_stocks, L.raw_news, L.raw_macro)
    batch.run(spark, tmp_root, layout="bucketed", buckets=16)

    def weekly():
        return sorted(map(tuple, io.read_table(spark, f"{tmp_root}/marts/fct_weekly_summary").groupBy("ticker").count().collect()))

    want = weekly()
    for t in spark.catalog.listTables():
        if t.name.startswith("tw_"):
            spark.sql(f"DROP TABLE {t.name}")
    batch.run(spark, tmp_root, from_step="gold", layout="bucketed", buckets=4)
    assert weekly() == want


def test_json_arrays_and_unparsable_records(spark, tmp_root):
    rows = [{"series_id": "DFF", "series_name": "n", "date": f"2024-01-{d:02d}", "value": 1.5, "frequency": "daily", "source": "s",
             "ingested_at": "2024-02-01T06:00:00.000001"} for d in range(1, 29)]
    from pathlib import Path

    for name in ("a", "b"):
        Path(tmp_root, f"{name}.json").write_text(json.dumps(rows, indent=2))
    got = io.read_raw_json(spark, tmp_root, schemas.RAW_MACRO, multi_line=True, with_corrupt=True).cache()
    assert got.count() == 56 and got.where(f"{io.CORRUPT} is not null").count() == 0
    by_line = io.read_raw_json(spark, tmp_root, schemas.RAW_MACRO, with_corrupt=True).cache()
    assert by_line.where(f"{io.CORRUPT} is not null").count() > 0


def test_a_strict_run_stops_at_unparsable_records(spark, tmp_root):
    L = Layers.from_testdata(spark, SF)
    batch.land(tmp_root, L.raw_stocks, L.raw_news, L.raw_macro)
    from pathlib import Path

    Path(tmp_root, "bronze/news/bad.json").write_text('{"title": "cut off')
    with pytest.raises(batch.QualityError, match="bronze.news=1"):
        batch.run(spark, tmp_root)


def test_no_local_folder_off_a_local_master(monkeypatch):
    sc = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: {}, setCheckpointDir=None)
    stub = types.SimpleNamespace(sparkContext=sc, conf={})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(stub)


def test_fixtures_represent_every_source_row(spark):
    events, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("events", "documents"))
    assert fixtures.raw_table(spark, SF, "px").count() == events.count()
    raw = fixtures.raw_stocks(spark, SF)
    assert raw.select("ticker").distinct().count() == events.select("user_id").distinct().count()
    assert fixtures.raw_news(spark, SF).where("title is not null").count() == docs.count()
    assert fixtures.raw_table(spark, SF, "ev").agg(F.countDistinct("event_type")).first()[0] == events.select("event_type").distinct().count()
    macro = fixtures.raw_table(spark, SF, "macro")
    assert macro.count() == fixtures.raw_table(spark, SF, "ev").count()
