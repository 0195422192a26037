"""Declarative column checks: not_null, unique, accepted_values.

Each check returns its failure count the way the data tests count it:
rows with a NULL value (not_null), values that occur more than once among
non-NULL values (unique), and distinct non-NULL values outside the list
(accepted_values). All not_null and accepted_values checks of one table
run in a single aggregate pass; each unique check is one grouped count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.exprs import quoted
from tidewatch.sources.schemas import SERIES_NAMES

from tidewatch.functions.signals import MARKET_SIGNALS, NEWS_INTENSITIES, TREND_POSITIONS, VOLUME_SIGNALS

# (test, model, column, accepted values or None)
Check = tuple[str, str, str, Sequence[str] | None]

# --- fixed values: the column checks declared for the models ----------------
CHECKS: list[Check] = [
    ("not_null", "fct_daily_market_summary", "date", None),
    ("not_null", "fct_daily_market_summary", "ticker", None),
    ("not_null", "fct_daily_market_summary", "close", None),
    ("not_null", "dim_tickers", "ticker", None),
    ("unique", "dim_tickers", "ticker", None),
    ("not_null", "fct_sentiment_sensitivity", "ticker", None),
    ("unique", "fct_sentiment_sensitivity", "ticker", None),
    ("not_null", "stg_daily_market", "date", None),
    ("not_null", "stg_daily_market", "ticker", None),
    ("not_null", "stg_daily_market", "close", None),
    ("not_null", "stg_daily_market", "sentiment_ratio", None),
    ("not_null", "fct_market_signals", "market_signal", None),
    ("accepted_values", "fct_market_signals", "market_signal", MARKET_SIGNALS),
    ("not_null", "fct_market_signals", "volume_signal", None),
    ("accepted_values", "fct_market_signals", "volume_signal", VOLUME_SIGNALS),
    ("not_null", "fct_market_signals", "trend_position", None),
    ("accepted_values", "fct_market_signals", "trend_position", TREND_POSITIONS),
    ("not_null", "fct_market_signals", "news_intensity", None),
    ("accepted_values", "fct_market_signals", "news_intensity", NEWS_INTENSITIES),
    ("not_null", "fct_weekly_summary", "ticker", None),
    ("not_null", "fct_weekly_summary", "week_start", None),
]

RESULT_COLUMNS = ["test_name", "model", "column_name", "failures"]


def _scan_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame | None:
    """not_null and accepted_values checks of one table in one pass over it.

    Rows are counted by their combination of labels first, which leaves few
    rows, so the distinct values are counted without repeating the table's rows.
    """
    labels = list(dict.fromkeys(c[2] for c in checks if c[0] == "accepted_values"))
    required = list(dict.fromkeys(c[2] for c in checks if c[0] == "not_null"))
    counted = df.groupBy(*labels).agg(*(F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in required),
                                      F.count(F.lit(1)).alias("_rows"))
    exprs = []
    for test, _, column, values in checks:
        if test == "not_null":
            e = F.coalesce(F.sum(f"_nulls_{column}"), F.lit(0))
        elif test == "accepted_values":
            e = F.count_distinct(F.when(~F.col(column).isin(list(values)), F.col(column)))
        else:
            continue
        exprs.append(F.struct(F.lit(test).alias("test_name"), F.lit(column).alias("column_name"),
                              e.cast("long").alias("failures")))
    if not exprs:
        return None
    one_row = counted.agg(F.array(*exprs).alias("checks"))
    return one_row.select(F.inline("checks")).select(
        "test_name", F.lit(model).alias("model"), "column_name", "failures"
    )


def _unique_check(df: DataFrame, model: str, column: str) -> DataFrame:
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique").alias("test_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        "failures",
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS,
               tests: Sequence[str] | None = None) -> DataFrame:
    """One row per check: test_name, model, column_name, failures."""
    chosen = [c for c in checks if tests is None or c[0] in tests]
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c[1] for c in chosen):
        mine = [c for c in chosen if c[1] == model]
        scanned = _scan_checks(tables[model], model, mine)
        if scanned is not None:
            parts.append(scanned)
        parts.extend(_unique_check(tables[model], model, c[2]) for c in mine if c[0] == "unique")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_report(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """All checks with a pass flag."""
    return run_checks(tables, checks).withColumn("passed", F.col("failures") == 0)


def unknown_series(macro: DataFrame, known: Sequence[str] = SERIES_NAMES) -> DataFrame | None:
    """One passed row per macro column that no model knows, with its values counted; None if there is none.

    The pivot keeps such a series, so it is told, and no data check fails.
    """
    new = [c for c in macro.columns if c != "date" and c not in known]
    if not new:
        return None
    values = {c: F.col(quoted(c)) for c in new}
    rows = F.array(*(F.struct(F.lit("unknown_series").alias("test_name"), F.lit("silver_macro").alias("model"), F.lit(c).alias("column_name"),
                              F.count(values[c]).alias("failures"), F.lit(True).alias("passed")) for c in new))
    return macro.agg(rows.alias("r")).select(F.inline("r"))
