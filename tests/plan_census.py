"""Plan census: per registered query, the physical operators that matter at scale.

Usage: python tests/plan_census.py [sf_dir] > PLANS.md

Counts come from ``explain("formatted")`` after the query has run (the
adaptive plan is then final). They include deriving the raw records from the
test tables, which adds aggregations of ``events`` to the price and macro
chains.
"""

from __future__ import annotations

import contextlib
import io as stdio
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [
    ("hash exchanges", r"Exchange\b.*hashpartitioning|^\(\d+\) Exchange$"),
]


def census(df) -> dict[str, int]:
    df.write.format("noop").mode("overwrite").save()
    buf = stdio.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    details = text.split("\n\n", 1)[1] if "\n\n" in text else text
    nodes = re.findall(r"^\((\d+)\) (\w+)", details, re.M)
    names = [n for _, n in nodes]
    args = re.findall(r"^Arguments: (.*)$", details, re.M)
    return {
        "hash exchange": sum(1 for a in args if a.startswith("hashpartitioning")),
        "range exchange": sum(1 for a in args if a.startswith("rangepartitioning")),
        "single-partition": sum(1 for a in args if a.startswith("SinglePartition")),
        "broadcast join": names.count("BroadcastHashJoin"),
        "shuffle join": names.count("SortMergeJoin") + names.count("ShuffledHashJoin"),
        "window": names.count("Window"),
        "partial group limit": sum(1 for a in args if a.rstrip().endswith("Partial")),
        "top-k": names.count("TakeOrderedAndProject"),
        "python": names.count("MapInPandas") + names.count("PythonMapInArrow"),
    }


def main(sf_dir: str) -> None:
    import __spark_entry__ as E
    from tidewatch.session import local_session

    spark = local_session(8)
    cols = None
    rows = []
    for key, fn in E.queries().items():
        if key in ("roundtrip_json", "roundtrip_partitioned", "roundtrip_tables", "layer_inventory", "layer_copy"):
            continue  # their work is writing and listing files
        c = census(fn(spark, sf_dir))
        cols = cols or list(c)
        rows.append((key, c))
    print("# Plan census\n")
    print(f"Physical plans of the registered queries at `{sf_dir}` (adaptive plans, final), generated by "
          "`python tests/plan_census.py`. Counts include deriving the raw records from the test tables. "
          "Cartesian products and nested-loop joins: none (asserted in `tests/test_plans.py`). "
          "Single-partition exchanges are the final merge of a global aggregate (one row per task) or "
          "of a top-k, never a window over a growing table.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---:" for _ in cols) + " |")
    for key, c in rows:
        print(f"| `{key}` | " + " | ".join(str(c[k]) for k in cols) + " |")
    bucketed_section(spark, sf_dir, cols)
    spark.stop()


def bucketed_section(spark, sf_dir: str, cols: list[str]) -> None:
    """The batch's own steps over the bucketed layout: what reuse of the bucketing saves."""
    from tidewatch.operators import gold as G
    from tidewatch.operators import marts as M
    from tidewatch.plans import batch as P
    from tidewatch.plans.layers import Layers
    from tidewatch.session import scratch_path
    from tidewatch.sources import storage

    L = Layers.from_testdata(spark, sf_dir)
    plans = {}
    for layout in ("clustered", "bucketed"):
        root = scratch_path(spark, f"census-{layout}")
        P.land(root, L.raw_stocks, L.raw_news, L.raw_macro)
        P.run(spark, root, layout=layout, buckets=8)
        lay = P.Layout(spark, root, layout, 8)
        news = storage.read_table(spark, f"{root}/silver/news")
        macro = storage.read_table(spark, f"{root}/silver/fred")
        gold = lay.read("gold", "fct_daily_market_summary")
        plans[layout] = {
            "gold from stored silver": G.daily_market_summary(lay.read("silver", "stocks"), G.daily_news(news), macro),
            "dim_tickers from stored gold": G.dim_tickers(gold),
            "sensitivity from stored gold": G.sentiment_sensitivity(gold),
            "weekly from stored signals": M.weekly_summary(lay.read("marts", "fct_market_signals")),
        }
    print("\n## The batch's steps, clustered against bucketed layout\n")
    print("The same steps read back from storage. With the bucketed layout the window and the "
          "per-ticker aggregates use the stored bucketing, so their hash exchange disappears.\n")
    print("| step | layout | " + " | ".join(cols) + " |")
    print("| --- | --- | " + " | ".join("---:" for _ in cols) + " |")
    for step in plans["clustered"]:
        for layout in ("clustered", "bucketed"):
            c = census(plans[layout][step])
            print(f"| {step} | {layout} | " + " | ".join(str(c[k]) for k in cols) + " |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
