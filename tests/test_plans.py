"""Plan shape checks through explain(): the plans we want at scale, kept."""

import contextlib
import io as stdio
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidewatch.plans import batch as P
from tidewatch.plans import reports as R
from tidewatch.plans.layers import Layers
from tidewatch.sources import storage as io

# Keys whose work is writing files or a file listing, checked elsewhere.
WRITERS = {"roundtrip_json", "roundtrip_partitioned", "roundtrip_tables", "layer_inventory", "layer_copy"}


def plan_of(df, mode="formatted") -> str:
    buf = stdio.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", [k for k in E.queries() if k not in WRITERS])
def test_no_cartesian_or_nested_loop_join(spark, key):
    text = plan_of(E.queries()[key](spark, SF_SMALL), "extended")
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_gold_plan_two_broadcasts_one_exchange_by_ticker(spark):
    L = Layers.from_testdata(spark, SF_SMALL)
    text = plan_of(L.gold)
    nodes = re.findall(r"^\(\d+\) (\w+)", text, re.M)  # one line per node in the details
    assert nodes.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in nodes
    # One ranking window for the de-duplication (with its partial group limit
    # below the exchange), one window for lag and both rolling frames.
    assert nodes.count("Window") == 2
    assert nodes.count("WindowGroupLimit") == 2
    # The only exchange above the de-duplication is the one by ticker for the window.
    window_exchanges = re.findall(r"hashpartitioning\(ticker#\d+, \d+\)", text)
    assert len(window_exchanges) == 1


@pytest.mark.parametrize("table", ["raw_stocks", "raw_macro"])
def test_fixtures_read_their_source_once(spark, table):
    text = plan_of(getattr(Layers.from_testdata(spark, SF_SMALL), table))
    nodes = re.findall(r"^\(\d+\) (\w+)", text, re.M)
    assert nodes.count("Scan") == 1 and "Union" not in nodes


def test_macro_fill_is_partitioned_by_series(spark):
    L = Layers.from_testdata(spark, SF_SMALL)
    text = plan_of(L.macro_ffill)
    assert re.search(r"hashpartitioning\(series_name#\d+", text)
    assert "SinglePartition" not in text


def test_scans_of_stored_tables_prune_and_push_down(spark, tmp_root):
    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root)
    sig = P.read_signals(spark, root)
    text = plan_of(R.ticker_history(sig, "T000001"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(ticker,T000001\)", text)
    dim_text = plan_of(io.read_table(spark, f"{root}/gold/fct_daily_market_summary").groupBy("ticker").count())
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", dim_text).group(1)
    assert read_schema == "ticker:string"


def test_top_k_reads_use_take_ordered(spark):
    text = plan_of(E.queries()["top_gainers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_bucketed_layout_reuses_partitioning(spark, tmp_root):
    from tidewatch.operators import gold as G
    from tidewatch.operators import marts as M

    L = Layers.from_testdata(spark, SF_SMALL)
    root = f"file://{tmp_root}/lake"
    P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
    P.run(spark, root, layout="bucketed", buckets=4)
    lay = P.Layout(spark, root, "bucketed", 4)
    silver = lay.read("silver", "stocks")
    gold_plan = plan_of(G.daily_market_summary(silver, L.daily_news, L.macro_ffill))
    assert "Bucketed: true" in gold_plan
    assert not re.search(r"hashpartitioning\(ticker#\d+, \d+\)", gold_plan)  # the window needs no shuffle
    gold = lay.read("gold", "fct_daily_market_summary")
    for df in (G.dim_tickers(gold), G.sentiment_sensitivity(gold),
               M.weekly_summary(lay.read("marts", "fct_market_signals"))):
        assert "Exchange" not in plan_of(df)  # per-ticker aggregates read the buckets as they are
    # A new process: the catalog has forgotten the table; it is declared again over the files.
    name = lay.table_name("gold", "fct_daily_market_summary")
    spark.sql(f"DROP TABLE {name}")  # unmanaged: the files stay
    again = lay.read("gold", "fct_daily_market_summary")
    assert again.count() == L.gold.count()
    assert "Exchange" not in plan_of(G.dim_tickers(again))
