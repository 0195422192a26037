"""The daily batch: (payloads -> bronze ->) silver -> gold -> marts -> checks -> views.

Each step reads the previous layer from storage and writes its own, so a
lost executor costs at most the running step's tasks, and no step keeps a
long lineage. Every write publishes a new version of its table as its last
act (``sources.publish``), so a step can be re-run and a broken one leaves the
tables as they were.
Steps run in order; ``from_step`` starts later, as a re-run after a failure
would. Layout under ``root``:

  landing/{stocks,news,fred}       payload files as the sources sent them
  bronze/{stocks,news,fred}        raw records: newline JSON landing batches, or the intake's plans
  silver/stocks, silver/news, silver/fred
  gold/fct_daily_market_summary, gold/dim_tickers, gold/fct_sentiment_sensitivity
  marts/fct_market_signals, marts/fct_weekly_summary, marts/quality_report

The per-ticker tables (silver/stocks, gold/fct_daily_market_summary,
marts/fct_market_signals) use one of three layouts:

``clustered`` (default): flat files, rows sorted by (ticker, date) within
  each file, written from the partitioning the plan already has, so the
  write adds no shuffle and the file count follows the task count.
``bucketed``: catalog tables bucketed by ticker (and sorted by date). The
  gold window reads silver without a shuffle, and the per-ticker aggregates
  (dimension, sensitivity, weekly) read gold without one: the partitioning
  is paid once, at the silver write, and reused by every later stage. The
  bucket spec lives in the session catalog and, as a count, beside the files;
  a new process declares the table again with that count.
``by_ticker``: one folder per ticker (directory pruning for one-ticker
  reads). Costs at least one file per ticker and write task, so it suits
  few, long tickers rather than many short ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import gold as G
from tidewatch.operators import marts as M
from tidewatch.operators import quality as Q
from tidewatch.operators import sentiment as SN
from tidewatch.operators import silver as SV
from tidewatch.operators.joins import materialise
from tidewatch.session import prepare
from tidewatch.sources import publish as PB
from tidewatch.sources import schemas
from tidewatch.sources import storage as io
from tidewatch.sources.intake import PAYLOADS, CorruptPayload, take_in

# A run starts at silver unless it is told to take in payloads first (``from_step="bronze"``).
BRONZE = "bronze"
STEPS = ["silver", "gold", "marts", "quality", "load"]
LAYOUTS = ("clustered", "bucketed", "by_ticker")
GOLD_TABLES = ["fct_daily_market_summary", "dim_tickers", "fct_sentiment_sensitivity"]


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def land(root: str, raw_stocks: DataFrame, raw_news: DataFrame, raw_macro: DataFrame) -> None:
    """Append one landing batch of raw records to bronze."""
    io.append_json(raw_stocks, _p(root, "bronze", "stocks"))
    io.append_json(raw_news, _p(root, "bronze", "news"))
    io.append_json(raw_macro, _p(root, "bronze", "fred"))


def bronze_step(spark: SparkSession, root: str, stamp: str | None = None, strict: bool = True) -> dict[str, int]:
    """Payload files that are new under ``landing`` to raw records in bronze; returns the files taken by source."""
    return {s: take_in(spark, root, s, _p(root, "landing", s), stamp, strict) for s in PAYLOADS}


class RowCounts(dict):
    """Rows per table, each settled once.

    Written tables are counted from the files of the published version, landed
    ones by an aggregate over them. Neither depends on how often a task or a
    stage ran, as counts taken along the way would.
    """

    def settle(self, name: str, rows: int) -> None:
        self[name] = {"rows": rows, "corrupt": 0}

    def count_raw(self, name: str, df: DataFrame) -> DataFrame:
        """Counts landed records and those that could not be parsed."""
        # All columns are counted, as a record is corrupt by any field that is read.
        counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns if c != io.CORRUPT]
        found = df.agg(F.count(F.lit(1)).alias("rows"), F.count(io.CORRUPT).alias("corrupt"), *counts).first()
        self[name] = {"rows": found["rows"], "corrupt": found["corrupt"]}
        return df.drop(io.CORRUPT)

    def result(self) -> dict[str, int]:
        return {k: int(v["rows"]) for k, v in self.items()}

    def corrupt(self) -> dict[str, int]:
        """Unparsable records by landed table, where there are any."""
        return {k: int(v["corrupt"]) for k, v in self.items() if v["corrupt"]}


class Layout:
    """How the per-ticker tables under ``root`` are written and read back."""

    def __init__(self, spark: SparkSession, root: str, kind: str = "clustered", buckets: int | None = None):
        if kind not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}")
        self.spark, self.root, self.kind = spark, root, kind
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tag = hashlib.sha1(root.encode()).hexdigest()[:10]

    def table_name(self, layer: str, table: str) -> str:
        return f"tw_{self._tag}_{layer}_{table}"

    def write(self, df: DataFrame, layer: str, table: str, counts: RowCounts) -> None:
        path, name = _p(self.root, layer, table), f"{layer}.{table}"
        if self.kind == "bucketed":
            rows = io.write_bucketed(df, path, self.table_name(layer, table), self.buckets)
        else:
            writer = io.write_partitioned if self.kind == "by_ticker" else io.write_clustered
            rows = PB.publish(self.spark, path, lambda folder: writer(df, folder))
        counts.settle(name, rows)

    def write_ordered(self, df: DataFrame, layer: str, table: str, by: list, counts: RowCounts,
                      after_exchange: Callable[[DataFrame], DataFrame] | None = None) -> None:
        path = _p(self.root, layer, table)
        counts.settle(f"{layer}.{table}", PB.publish(self.spark, path, lambda folder: io.write_ordered(df, folder, by, after_exchange)))

    def read(self, layer: str, table: str, schema=None) -> DataFrame:
        path = _p(self.root, layer, table)
        if self.kind == "bucketed":
            return io.bucketed_table(self.spark, self.table_name(layer, table), path)
        df = io.read_table(self.spark, path, schema)
        # Partition discovery would type number-like tickers as numbers.
        return df if schema is not None else df.withColumn("ticker", df["ticker"].cast("string"))


def _layout(spark: SparkSession, root: str, layout: str | Layout) -> Layout:
    return layout if isinstance(layout, Layout) else Layout(spark, root, layout)


def silver_step(spark: SparkSession, root: str, scorer_factory: Callable | None = None,
                layout: str | Layout = "clustered", counts: RowCounts | None = None,
                multi_line: bool | None = False, lexicon: dict[str, list[str]] | None = None) -> None:
    """Bronze to silver. ``multi_line``: each landed file is one JSON array; None: files of any form.

    News are scored by ``scorer_factory``, else by the word lists of
    ``lexicon`` (positive, negative), else by the lists for the test tables.
    """
    lay = _layout(spark, root, layout)
    counts = RowCounts() if counts is None else counts

    def raw(name: str, schema) -> DataFrame:
        found = io.read_raw_json(spark, _p(root, "bronze", name), schema, multi_line, with_corrupt=True)
        return counts.count_raw(f"bronze.{name}", found)

    raw_s, raw_n, raw_m = raw("stocks", schemas.RAW_STOCKS), raw("news", schemas.RAW_NEWS), raw("fred", schemas.RAW_MACRO)
    lay.write(SV.clean_stocks(raw_s), "silver", "stocks", counts)
    news = SV.clean_news(raw_n)

    def scored(ranged: DataFrame) -> DataFrame:
        return SN.score_news(ranged, **(lexicon or {})) if scorer_factory is None else SN.score_news_with_model(ranged, scorer_factory)

    lay.write_ordered(news, "silver", "news", ["date", "published_at", "url"], counts, scored)
    macro = SV.macro_ffill(SV.clean_macro(raw_m), SV.series_found(SV.typed_macro(raw_m)))
    lay.write_ordered(macro, "silver", "fred", ["date"], counts)


def gold_step(spark: SparkSession, root: str, layout: str | Layout = "clustered",
              counts: RowCounts | None = None) -> None:
    lay = _layout(spark, root, layout)
    counts = RowCounts() if counts is None else counts
    stocks = lay.read("silver", "stocks", schemas.SILVER_STOCKS)
    news = io.read_table(spark, _p(root, "silver", "news"))
    macro = io.read_table(spark, _p(root, "silver", "fred"))
    gold = G.daily_market_summary(stocks, G.daily_news(news), macro)
    lay.write(gold, "gold", "fct_daily_market_summary", counts)
    stored = read_gold(spark, root, lay)
    # A row per ticker: stored once before the order is found, so gold is read once for each.
    dim, sens = materialise(G.dim_tickers(stored), "dim"), materialise(G.sentiment_sensitivity(stored), "sensitivity")
    lay.write_ordered(dim, "gold", "dim_tickers", ["ticker"], counts)
    lay.write_ordered(sens, "gold", "fct_sentiment_sensitivity", [F.desc_nulls_last("sentiment_sensitivity"), F.asc("ticker")], counts)


def read_gold(spark: SparkSession, root: str, layout: str | Layout = "clustered") -> DataFrame:
    return _layout(spark, root, layout).read("gold", "fct_daily_market_summary")


def read_signals(spark: SparkSession, root: str, layout: str | Layout = "clustered") -> DataFrame:
    return _layout(spark, root, layout).read("marts", "fct_market_signals")


def marts_step(spark: SparkSession, root: str, layout: str | Layout = "clustered",
               counts: RowCounts | None = None) -> None:
    lay = _layout(spark, root, layout)
    counts = RowCounts() if counts is None else counts
    sig = M.market_signals(M.stg_daily_market(read_gold(spark, root, lay)))
    lay.write(sig, "marts", "fct_market_signals", counts)
    stored = read_signals(spark, root, lay)
    weekly = materialise(M.weekly_summary(stored), "weekly")
    lay.write_ordered(weekly, "marts", "fct_weekly_summary", ["ticker", "week_start"], counts)


def model_tables(spark: SparkSession, root: str, layout: str | Layout = "clustered") -> dict[str, DataFrame]:
    lay = _layout(spark, root, layout)
    gold = read_gold(spark, root, lay)
    return {
        "fct_daily_market_summary": gold,
        "dim_tickers": io.read_table(spark, _p(root, "gold", "dim_tickers")),
        "fct_sentiment_sensitivity": io.read_table(spark, _p(root, "gold", "fct_sentiment_sensitivity")),
        "stg_daily_market": M.stg_daily_market(gold),
        "fct_market_signals": read_signals(spark, root, lay),
        "fct_weekly_summary": io.read_table(spark, _p(root, "marts", "fct_weekly_summary")),
    }


class QualityError(RuntimeError):
    """Raised after the report is written, when a declared check failed."""


def quality_step(spark: SparkSession, root: str, layout: str | Layout = "clustered",
                 strict: bool = True) -> DataFrame:
    """Write the check report; with ``strict``, stop the batch if any check failed.

    The report has one row per declared check, and one per macro series that
    the models do not know (which is told, not failed), so reading its failures
    back is bounded by the number of checks, not by the data.
    """
    report = Q.quality_report(model_tables(spark, root, layout))
    if (unknown := Q.unknown_series(io.read_table(spark, _p(root, "silver", "fred")))) is not None:
        report = report.unionByName(unknown)
    path = _p(root, "marts", "quality_report")
    PB.publish(spark, path, lambda folder: io.write_flat(report.coalesce(1), folder))
    stored = io.read_table(spark, path)
    if strict:
        failed = stored.where(~F.col("passed")).collect()
        if failed:
            names = ", ".join(f"{r.test_name}({r.model}.{r.column_name})={r.failures}" for r in failed)
            raise QualityError(f"{len(failed)} data check(s) failed: {names}")
    return stored


def load_step(spark: SparkSession, root: str, layout: str | Layout = "clustered", database: str | None = None) -> DataFrame:
    """Register the gold and mart tables as session views, and list them.

    With ``database`` the stored ones become tables of that catalog database too.
    """
    lay = _layout(spark, root, layout)
    names = []
    for layer, table in [("gold", "fct_daily_market_summary"), ("marts", "fct_market_signals")]:
        try:
            lay.read(layer, table).createOrReplaceTempView(table)
            names.append(table)
        except Exception as e:  # an absent table is skipped, as for the flat ones
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
    if "fct_daily_market_summary" in names:
        # The staging model stays a view over gold, as it is not stored.
        M.stg_daily_market(spark.table("fct_daily_market_summary")).createOrReplaceTempView("stg_daily_market")
        names.append("stg_daily_market")
    names += io.register_tables(spark, _p(root, "gold"), ["dim_tickers", "fct_sentiment_sensitivity"])
    names += io.register_tables(spark, _p(root, "marts"), ["fct_weekly_summary"])
    if database is not None:
        layer = {"fct_market_signals": "marts", "fct_weekly_summary": "marts"}
        io.register_database(spark, database, {
            n: _p(root, layer.get(n, "gold"), n) for n in names if n != "stg_daily_market"})
    order = ["fct_daily_market_summary", "dim_tickers", "fct_sentiment_sensitivity",
             "stg_daily_market", "fct_market_signals", "fct_weekly_summary"]
    return io.table_listing(spark, [n for n in order if n in names])


def run(spark: SparkSession, root: str, from_step: str | None = None,
        scorer_factory: Callable | None = None, layout: str = "clustered",
        counts: RowCounts | None = None, buckets: int | None = None, strict: bool = True,
        multi_line: bool | None = False, lexicon: dict[str, list[str]] | None = None, database: str | None = None) -> DataFrame:
    """Run the steps from ``from_step`` on; returns the registered-table listing.

    ``from_step="bronze"`` first takes in the payload files that have landed
    since the last run (``sources.intake``). ``multi_line`` reads landed files
    that each hold one JSON array, or any mix of forms if None. Records
    that cannot be parsed (also arrays read line by line) stop a strict run
    after the silver step, with ``QualityError``.

    Pass a ``RowCounts`` to get the rows read and written by each step
    (``counts.result()`` after the run). With ``strict`` (default) a failed
    data check stops the run after the quality step, with ``QualityError``.
    ``scorer_factory`` or ``lexicon`` choose how news are scored (see
    ``silver_step``). With ``database`` the load step also keeps the tables in
    that catalog database, for later sessions.
    """
    prepare(spark)
    lay = Layout(spark, root, layout, buckets)
    counts = RowCounts() if counts is None else counts
    if from_step == BRONZE:
        bronze_step(spark, root, strict=strict)
        from_step = None
    start = STEPS.index(from_step) if from_step else 0
    listing = None
    for step in STEPS[start:]:
        if step == "silver":
            silver_step(spark, root, scorer_factory, lay, counts, multi_line, lexicon)
            if strict and (bad := counts.corrupt()):
                raise QualityError("unparsable landed records: " + ", ".join(f"{k}={n}" for k, n in bad.items()))
        elif step == "gold":
            gold_step(spark, root, lay, counts)
        elif step == "marts":
            marts_step(spark, root, lay, counts)
        elif step == "quality":
            quality_step(spark, root, lay, strict)
        elif step == "load":
            listing = load_step(spark, root, lay, database)
    return listing


def main(argv: list[str] | None = None) -> int:
    """``python -m tidewatch.plans.batch ROOT [--from STEP] [--layout L] [--buckets N]
    [--multi-line | --any-form] [--database D] (--lexicon FILE | --model M --tokenizer T)``.

    A run that scores news (from the silver step on) must name its scorer.

    Runs the batch on the session ``spark-submit`` provides (or a local one)
    and prints the rows each step read and wrote, then the loaded tables.
    """
    import argparse
    import json

    parser = argparse.ArgumentParser(prog="tidewatch.plans.batch")
    parser.add_argument("root", help="lake root URI holding bronze/, silver/, gold/, marts/")
    parser.add_argument("--from", dest="from_step", choices=[BRONZE, *STEPS], default=None, help="start at this step")
    parser.add_argument("--layout", choices=LAYOUTS, default="bucketed",
                        help="per-ticker table layout (default: bucketed, reused partitioning)")
    parser.add_argument("--buckets", type=int, default=None, help="bucket count for --layout bucketed")
    parser.add_argument("--multi-line", action="store_true", help="landed files hold one JSON array each")
    parser.add_argument("--any-form", action="store_true", help="landed files hold records by line or arrays, in any mix and size")
    parser.add_argument("--lexicon", help="JSON file of word lists that score the news: {\"positive\": [...], \"negative\": [...]}")
    parser.add_argument("--database", help="catalog database that keeps the gold and mart tables")
    parser.add_argument("--model", help="exported ONNX classifier that scores the news")
    parser.add_argument("--tokenizer", help="tokenizer.json of the model")
    parser.add_argument("--labels", default="positive,negative,neutral", help="the model's labels, in output order")
    parser.add_argument("--no-strict", dest="strict", action="store_false",
                        help="do not stop when a data check fails")
    args = parser.parse_args(argv)
    if bool(args.model) != bool(args.tokenizer):
        parser.error("--model and --tokenizer go together")
    if args.from_step in (None, BRONZE, "silver") and bool(args.model) == bool(args.lexicon):
        parser.error("name one scorer of the news: --lexicon FILE or --model and --tokenizer")
    lexicon = None
    if args.lexicon:
        with open(args.lexicon, encoding="utf-8") as f:
            found = json.load(f)
        lexicon = {k: list(found[k]) for k in ("positive", "negative")}
    scorer = SN.onnx_factory(args.model, args.tokenizer, args.labels.split(",")) if args.model else None

    spark = SparkSession.builder.appName("tidewatch-batch").getOrCreate()
    counts = RowCounts()
    try:
        listing = run(spark, args.root, from_step=args.from_step, scorer_factory=scorer, layout=args.layout,
                      counts=counts, buckets=args.buckets, strict=args.strict, multi_line=None if args.any_form else args.multi_line,
                      lexicon=lexicon, database=args.database)
    except (QualityError, CorruptPayload) as e:
        print(json.dumps({"rows": counts.result(), "failed": str(e)}))
        return 1
    print(json.dumps({"rows": counts.result()}))
    if listing is not None:
        for r in listing.collect():  # one row per loaded table
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
