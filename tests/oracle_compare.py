"""Run queries() against oracle_sql() on DuckDB and compare, like the driver.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def compare(spark, con, key: str, fn, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = df.collect()
    cols = df.columns
    t1 = time.time()
    if sql is None:
        return True, f"rows-only {len(rows)} rows spark {t1 - t0:.1f}s"
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: spark-only {sorted(set(cols) - set(ocols))} oracle-only {sorted(set(ocols) - set(cols))}"
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    a = sorted((tuple(canon(r[i]) for i in si) for r in rows), key=repr)
    b = sorted((tuple(canon(r[i]) for i in oi) for r in orows), key=repr)
    if len(a) != len(b):
        return False, f"row count spark {len(a)} oracle {len(b)}"
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        x, y = diffs[0]
        cd = [(order[i], x[i], y[i]) for i in range(len(order)) if x[i] != y[i]]
        return False, f"{len(diffs)} rows differ; first: {cd[:5]}"
    return True, f"{len(a)} rows match spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tidewatch.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            ok, msg = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {key}: {msg}", flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
