"""Sentiment scoring paths, raw shaping, storage round trips and the pipeline."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewatch.functions.lexicon import lexicon_score_pandas
from tidewatch.operators import sentiment as SN
from tidewatch.plans import batch as P
from tidewatch.plans.layers import Layers
from tidewatch.sources import publish as PB
from tidewatch.sources import raw as RW
from tidewatch.sources import schemas
from tidewatch.sources import storage as io


def test_lexicon_expression_equals_pandas_scorer(spark):
    L = Layers.from_testdata(spark, SF_SMALL)
    expr = SN.score_news(L.news_clean)
    model = SN.score_news_with_model(L.news_clean, batch_size=7)
    assert expr.count() == model.count()
    assert expr.exceptAll(model).count() == 0


def test_model_scorer_is_built_once_per_task_and_labels_checked(spark):
    df = spark.createDataFrame([("good day",), (None,)], "title string").select(
        "title", *[F.lit(None).cast(t).alias(c) for c, t in [
            ("description", "string"), ("source_name", "string"), ("url", "string"),
            ("published_at", "timestamp_ntz"), ("date", "date"), ("search_query", "string"),
            ("source", "string"), ("ingested_at", "timestamp_ntz")]])

    def bad_factory():
        return lambda texts: (["bullish"] * len(texts), [1.0] * len(texts))

    with pytest.raises(Exception, match="unknown labels"):
        SN.score_news_with_model(df, bad_factory).collect()

    def const_factory():
        return lambda texts: (["negative"] * len(texts), [0.123456] * len(texts))

    rows = SN.score_news_with_model(df, const_factory).collect()
    assert {(r.sentiment_label, r.sentiment_score, r.sentiment_directional) for r in rows} == {
        ("negative", 0.1235, -0.1235)}


def test_pandas_lexicon_rule():
    labels, scores = lexicon_score_pandas(["The cat on the mat", "of to in", "", None])
    assert labels == ["positive", "negative", "neutral", "neutral"]
    assert scores == [1.0, 1.0, 0.0, 0.0]


def test_news_records_first_url_wins(spark):
    art = "struct<title:string,description:string,content:string,url:string,publishedAt:string,source:struct<name:string>>"
    payloads = spark.createDataFrame(
        [
            (1, 0, [("late", None, None, "u1", "t", ("S",)), ("x", None, None, None, "t", ("S",))]),
            (0, 0, [("early", None, None, "u1", "t", ("S",)), ("y", None, None, None, "t", ("S",))]),
        ],
        f"query_pos bigint, page bigint, articles array<{art}>",
    )
    out = {r.url: r for r in RW.news_records(payloads).collect()}
    assert out["u1"].title == "early" and out["u1"].search_query == schemas.SEARCH_QUERIES[0]
    assert out[""].title == "y" and out["u1"].source_name == "S"


def test_macro_records_drop_nan_and_unknown(spark):
    obs = spark.createDataFrame(
        [("DFF", 5.123456), ("DFF", float("nan")), ("ZZZ", 1.0), ("VIXCLS", None)], "series_id string, value double"
    ).withColumn("obs_date", F.to_date(F.lit("2024-01-02")))
    rows = RW.macro_records(obs).collect()
    assert [(r.series_name, r.value, r.frequency, r.date) for r in rows] == [
        ("federal_funds_rate", 5.1235, "daily", "2024-01-02")]


def test_lookback_bounds(spark):
    df = spark.createDataFrame([("2023-12-20",), ("2023-12-21",), ("2024-01-20",), ("2024-01-21",)], "date string")
    kept = sorted(r.date for r in RW.lookback(df, "2024-01-20", 30).collect())
    assert kept == ["2023-12-21", "2024-01-20"]


def test_multiline_json_array_read(spark, tmp_root):
    path = os.path.join(tmp_root, "fred")
    os.makedirs(path)
    recs = [{"series_id": "DFF", "series_name": "federal_funds_rate", "date": "2026-02-15", "value": 3.64,
             "frequency": "daily", "source": "fred", "ingested_at": "2026-03-17T12:40:04.1"}] * 3
    with open(os.path.join(path, "fred_1.json"), "w") as f:
        json.dump(recs, f, indent=2)
    df = io.read_raw_json(spark, path, schemas.RAW_MACRO, multi_line=True)
    assert df.count() == 3 and df.first().value == 3.64


def test_partitioned_roundtrip_keeps_string_tickers(spark, tmp_root):
    df = spark.createDataFrame([("0700", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 5, "s", "2024-02-01T06:00:00")],
                               schemas.RAW_STOCKS)
    from tidewatch.operators.silver import clean_stocks

    path = f"file://{tmp_root}/silver"
    io.write_partitioned(clean_stocks(df), path)
    back = io.read_table(spark, path, schemas.SILVER_STOCKS)
    assert back.first().ticker == "0700"
    assert os.path.isdir(os.path.join(tmp_root, "silver", "ticker=0700"))


def test_partitioned_write_keeps_its_ranges_apart_however_few_bytes_they_hold(spark, tmp_root):
    df = spark.range(200).select(F.format_string("T%03d", "id").alias("ticker"), F.date_add(F.lit("2024-01-02").cast("date"), F.col("id").cast("int") % 5).alias("date"))
    io.write_partitioned(df, f"file://{tmp_root}/many")
    names = [f for _, _, files in os.walk(os.path.join(tmp_root, "many")) for f in files if f.endswith(".parquet")]
    # Every ticker has its folder and file; the files come from as many tasks as there are ranges, not from a few merged ones.
    assert len(names) == 200 and len({n.split("-")[1] for n in names}) >= spark.sparkContext.defaultParallelism
    back = spark.read.parquet(f"file://{tmp_root}/many").select("ticker", "date")
    assert back.exceptAll(df).count() == 0 and back.count() == 200


def test_register_tables_skips_absent(spark, tmp_root):
    spark.range(3).write.parquet(f"file://{tmp_root}/present")
    names = io.register_tables(spark, f"file://{tmp_root}", ["present", "absent"])
    assert names == ["present"]
    assert io.table_listing(spark, names).first().row_count == 3


@pytest.mark.parametrize("layout", ["clustered", "bucketed", "by_ticker"])
def test_pipeline_equals_in_memory_chain(spark, tmp_root, layout):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    counts = P.RowCounts()
    listing = {r.table_name: r.row_count for r in P.run(spark, root, layout=layout, counts=counts).collect()}
    assert listing["fct_daily_market_summary"] == L.gold.count()
    observed = counts.result()
    assert observed["bronze.stocks"] == L.raw_stocks.count()
    assert observed["silver.stocks"] == L.silver_stocks.count()
    assert observed["gold.fct_daily_market_summary"] == listing["fct_daily_market_summary"]
    assert observed["marts.fct_weekly_summary"] == L.weekly.count()
    stored = P.read_gold(spark, root, layout).select(*L.gold.columns)
    assert stored.exceptAll(L.gold).count() == 0
    report = io.read_table(spark, f"{root}/marts/quality_report")
    assert report.where(~F.col("passed")).count() == 0 and report.count() == 21
    inv = {(r.layer, r.table) for r in io.layer_inventory(spark, root).collect()}
    assert ("silver", "stocks") in inv and ("gold", "dim_tickers") in inv and ("bronze", "news") in inv
    # Re-run from a later step, as after a failure.
    P.run(spark, root, from_step="marts", layout=layout)


def test_streaming_increments_equal_batch(spark, tmp_root):
    from tidewatch.operators import silver as SV
    from tidewatch.streaming.landing import silver_view, start_ingest

    L = Layers.from_testdata(spark, SF_SMALL)
    expected = {
        "stocks": SV.clean_stocks(L.raw_stocks),
        "news": SN.score_news(SV.clean_news(L.raw_news)),
        "fred": SV.macro_ffill(SV.clean_macro(L.raw_macro)),
    }
    for source, raw in [("stocks", L.raw_stocks), ("news", L.raw_news), ("fred", L.raw_macro)]:
        bronze, inc, ck = (f"file://{tmp_root}/{source}/{n}" for n in ("bronze", "inc", "ck"))
        # Two landing batches: the later ingestions arrive after the first run.
        io.append_json(raw.where(F.col("ingested_at") < "2024-02-01T06:30"), bronze)
        start_ingest(spark, source, bronze, inc, ck).awaitTermination()
        io.append_json(raw.where(F.col("ingested_at") >= "2024-02-01T06:30"), bronze)
        start_ingest(spark, source, bronze, inc, ck).awaitTermination()
        view = silver_view(spark, source, inc).select(*expected[source].columns)
        assert view.count() == expected[source].count(), source
        assert view.exceptAll(expected[source]).count() == 0, source


def test_dashboard_sql_runs_on_registered_views(spark, tmp_root):
    """Dashboard SQL runs unchanged through spark.sql on the loaded views, with bound parameters."""
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root)
    first = spark.sql("SELECT DISTINCT ticker FROM fct_market_signals ORDER BY ticker").first().ticker
    history = spark.sql(
        "SELECT date, close, daily_return, market_signal FROM fct_market_signals WHERE ticker = :t ORDER BY date",
        args={"t": first},
    )
    assert history.count() == L.signals.where(F.col("ticker") == first).count()
    top = spark.sql(
        "SELECT ticker, daily_return FROM fct_market_signals "
        "WHERE date = (SELECT max(date) FROM fct_market_signals) ORDER BY daily_return DESC LIMIT 5"
    ).collect()
    assert len(top) == 5
    staged = spark.sql("SELECT count(*) AS n FROM stg_daily_market WHERE has_sentiment_data").first().n
    assert staged == L.stg.where("has_sentiment_data").count()
    heat = spark.sql(
        "SELECT date, ticker, daily_return FROM fct_market_signals "
        "WHERE date >= (SELECT max(date) - INTERVAL 14 DAY FROM fct_market_signals)"
    )
    assert heat.count() > 0


def test_onnx_model_scorer_whole_text_windows(spark, tmp_root):
    import numpy as np

    from tests.onnx_tiny import reference_scores, write

    vocab = {"[PAD]": 0, "[UNK]": 1, "the": 2, "on": 3, "en": 4, "of": 5, "to": 6, "er": 7, "in": 8}
    table = np.zeros((9, 3))
    table[1] = [0.0, 0.0, 0.05]
    table[2:5] = [1.0, 0.0, 0.0]
    table[5:9] = [0.0, 1.0, 0.0]
    model, tok = write(tmp_root, vocab, table)
    L = Layers.from_testdata(spark, SF_SMALL)
    # 16-token windows: long documents are scored over many windows, never cut.
    scored = SN.score_news_with_model(L.news_clean, SN.onnx_factory(model, tok, max_length=16))
    rows = scored.select("url", "title", "sentiment_label", "sentiment_score", "sentiment_directional").collect()
    labels, scores = reference_scores([r.title for r in rows], vocab, table, SN.LABELS, 16)
    assert [r.sentiment_label for r in rows] == labels
    assert max(abs(r.sentiment_score - s) for r, s in zip(rows, scores)) <= 1e-4
    assert all(r.sentiment_directional == {"positive": 1, "negative": -1}.get(r.sentiment_label, 0) * r.sentiment_score
               for r in rows)
    assert len(rows) == L.news_clean.count()


def test_landed_news_payload_files(spark, tmp_root):
    folder = os.path.join(tmp_root, "news_payloads")
    os.makedirs(folder)
    responses = [
        {"query_pos": 1, "page": 0, "articles": [
            {"title": "Late copy", "url": "https://n/1", "publishedAt": "2024-01-02T09:00:00Z", "source": {"name": "B"}},
            {"title": "No link", "publishedAt": "2024-01-02T10:00:00Z", "source": {"name": "B"}}]},
        {"query_pos": 0, "page": 0, "articles": [
            {"title": "First copy", "url": "https://n/1", "publishedAt": "2024-01-02T09:00:00Z", "source": {"name": "A"},
             "description": "d", "content": "c"}]},
    ]
    for i, r in enumerate(responses):  # one pretty-printed response per file, as an extractor saves it
        with open(os.path.join(folder, f"news_{i}.json"), "w") as f:
            json.dump(r, f, indent=2)
    payloads = io.read_raw_json(spark, folder, schemas.NEWS_PAYLOAD, multi_line=True)
    out = {r.url: r for r in RW.news_records(payloads).collect()}
    assert set(out) == {"https://n/1", ""}
    first = out["https://n/1"]
    assert (first.title, first.source_name, first.search_query, first.content_snippet) == (
        "First copy", "A", schemas.SEARCH_QUERIES[0], "c")
    assert out[""].title == "No link" and out[""].search_query == schemas.SEARCH_QUERIES[1]


def test_batch_stops_when_a_data_check_fails(spark, tmp_root):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root, from_step="silver", strict=True)  # clean data: passes
    # Corrupt the stored signals: an unknown label must stop the run at the quality step.
    sig = P.read_signals(spark, root)
    bad = sig.withColumn("market_signal", F.when(F.col("ticker") == sig.agg(F.min("ticker")).scalar(),
                                                 F.lit("sideways")).otherwise(F.col("market_signal")))
    side = f"file://{tmp_root}/bad_signals"  # written aside first: a path cannot be read and overwritten at once
    io.write_clustered(bad, side)
    PB.publish(spark, f"{root}/marts/fct_market_signals", spark.read.parquet(side).write.parquet)
    with pytest.raises(P.QualityError, match="accepted_values"):
        P.run(spark, root, from_step="quality", strict=True)
    report = io.read_table(spark, f"{root}/marts/quality_report")
    assert report.where(~F.col("passed")).count() == 1  # the report is written before stopping
    listing = P.run(spark, root, from_step="quality", strict=False)
    assert listing.count() == 6


def test_command_line_runs_and_resumes(spark, tmp_root, capsys):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    with pytest.raises(SystemExit):  # no scorer named
        P.main([root, "--buckets", "4"])
    words = f"{tmp_root}/words.json"
    with open(words, "w") as f:
        json.dump({"positive": ["the", "on", "en"], "negative": ["of", "to", "er", "in"]}, f)
    spark.sql("DROP DATABASE IF EXISTS tw_test_market CASCADE")
    assert P.main([root, "--buckets", "4", "--lexicon", words, "--database", "tw_test_market"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert lines[0]["rows"]["silver.stocks"] == L.silver_stocks.count()
    assert {x["table_name"] for x in lines[1:]} >= {"fct_daily_market_summary", "fct_market_signals"}
    kept = {r.tableName for r in spark.sql("SHOW TABLES IN tw_test_market").where("not isTemporary").collect()}
    assert kept == {"fct_daily_market_summary", "dim_tickers", "fct_sentiment_sensitivity", "fct_market_signals", "fct_weekly_summary"}
    per_ticker = spark.table("tw_test_market.fct_market_signals").groupBy("ticker").count()
    assert per_ticker.count() == L.silver_stocks.select("ticker").distinct().count()
    news = io.read_table(spark, f"{root}/silver/news")
    assert news.exceptAll(SN.score_news(L.news_clean).select(news.columns)).count() == 0
    spark.sql("DROP DATABASE tw_test_market CASCADE")
    assert P.main([root, "--buckets", "4", "--from", "marts"]) == 0
    again = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert set(again[0]["rows"]) == {"marts.fct_market_signals", "marts.fct_weekly_summary"}
