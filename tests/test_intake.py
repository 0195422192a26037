"""Payload files become raw records once each, also over broken and repeated runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import batch as P
from tidewatch.sources import fixtures, intake, landed, schemas
from tidewatch.sources import publish as PB
from tidewatch.sources import raw as RW
from tidewatch.sources import storage as io

SF = "/root/testdata/sf0.001"


def land(root, source, name, rows, indent=2):
    os.makedirs(f"{root}/landing/{source}", exist_ok=True)
    with open(f"{root}/landing/{source}/{name}.json", "w") as f:
        json.dump(rows, f, indent=indent)


def observations(days):
    return [{"series_id": "DFF", "obs_date": f"2024-01-{d:02d}", "value": d / 3} for d in days]


def bronze(spark, root, source, schema):
    return io.read_raw_json(spark, f"file://{root}/bronze/{source}", schema)


def test_each_file_once(spark, tmp_root):
    root, landing = f"file://{tmp_root}", f"file://{tmp_root}/landing/fred"
    assert intake.take_in(spark, root, "fred", landing) == 0
    land(tmp_root, "fred", "a", observations(range(1, 4)))
    land(tmp_root, "fred", "b", observations(range(4, 6)), indent=None)
    assert intake.take_in(spark, root, "fred", landing, "2024-02-01T00:00:00.000001") == 2
    assert intake.take_in(spark, root, "fred", landing) == 0
    land(tmp_root, "fred", "c", observations([9]))
    assert intake.take_in(spark, root, "fred", landing, "2024-02-02T00:00:00.000001") == 1
    got = bronze(spark, tmp_root, "fred", schemas.RAW_MACRO).collect()
    assert sorted(r.date for r in got) == [f"2024-01-0{d}" for d in (1, 2, 3, 4, 5, 9)]
    assert {r.date: r.ingested_at[:10] for r in got}["2024-01-09"] == "2024-02-02"


@pytest.mark.parametrize("dies_at", ["plans", "_planned", "data", "_done"])
def test_a_run_that_dies_is_taken_up(spark, tmp_root, monkeypatch, dies_at):
    root, landing = f"file://{tmp_root}", f"file://{tmp_root}/landing/fred"
    land(tmp_root, "fred", "a", observations(range(1, 4)))
    true = PB._create
    with monkeypatch.context() as m:
        if dies_at == "data":
            m.setattr(intake, "read_landed_json", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        else:
            kind = {"plans": "_planned"}.get(dies_at, dies_at)

            def create(s, path):
                if f"/{kind}/" in path:
                    if dies_at == "_planned":
                        true(s, path)
                    raise KeyboardInterrupt
                return true(s, path)

            m.setattr(PB, "_create", create)
        with pytest.raises(KeyboardInterrupt):
            intake.take_in(spark, root, "fred", landing, "2024-02-01T00:00:00.000001")
    land(tmp_root, "fred", "b", observations([7]))  # lands between the two runs
    assert intake.take_in(spark, root, "fred", landing, "2024-02-03T00:00:00.000001") == 2
    assert intake.take_in(spark, root, "fred", landing) == 0
    got = bronze(spark, tmp_root, "fred", schemas.RAW_MACRO).collect()
    assert sorted(r.date for r in got) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-07"]


def test_payloads_that_cannot_be_parsed_stop_a_strict_run(spark, tmp_root):
    root, landing = f"file://{tmp_root}", f"file://{tmp_root}/landing/fred"
    land(tmp_root, "fred", "a", observations([1]))
    with open(f"{tmp_root}/landing/fred/bad.json", "w") as f:
        f.write('[{"series_id": "DFF", "obs_date": }]')
    with pytest.raises(intake.CorruptPayload, match="fred: 1"):
        intake.take_in(spark, root, "fred", landing)
    assert not os.path.exists(f"{tmp_root}/bronze/fred")
    assert intake.take_in(spark, root, "fred", landing, strict=False) == 2
    assert bronze(spark, tmp_root, "fred", schemas.RAW_MACRO).count() == 1


def test_batch_from_payloads(spark, tmp_root):
    root = f"file://{tmp_root}"
    for source, df in (("stocks", fixtures.raw_table(spark, SF, "price_history")), ("fred", fixtures.raw_table(spark, SF, "macro_obs")),
                       ("news", fixtures.news_payloads(spark, SF))):
        landed.write_json_arrays(df, f"{root}/landing/{source}")
    P.run(spark, root, from_step="bronze")
    once = {s: bronze(spark, tmp_root, s, schemas.RAW_STOCKS).count() for s in ("stocks", "news", "fred")}
    assert once["stocks"] == RW.price_records(fixtures.raw_table(spark, SF, "price_history")).count()
    P.bronze_step(spark, root)
    assert {s: bronze(spark, tmp_root, s, schemas.RAW_STOCKS).count() for s in once} == once
    weekly = io.read_table(spark, f"{root}/marts/fct_weekly_summary")
    assert weekly.count() > 0 and weekly.where(F.col("ticker").isNull()).count() == 0
