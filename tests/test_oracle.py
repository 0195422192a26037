"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tidewatch.plans.catalog import QUERIES
from tests.oracle_compare import compare, duck
from tests.conftest import SF_SMALL

# The keys of this package; optional parts test their own.
KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle_or_is_rows_only():
    sql = E.oracle_sql()
    missing = [k for k in KEYS if k not in sql]
    assert set(missing) == E.ROWS_ONLY


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF_SMALL)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 26
    assert df.count() > 0
