"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python -m tests.oracle_check [sf_dir] [query ...]``.  The compare
mirrors the driver's: same column names, same row count, same multiset of
rows (floats rounded, timestamps as text).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

from corral.plans.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return True, f"rows-only {len(s_rows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diff}"
    return True, f"{len(s_rows)} rows ({t1 - t0:.1f}s)"


def main(argv):
    import __spark_entry__ as entry
    from corral.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            ok, msg = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and go on
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{len(names or qs) - bad}/{len(names or qs)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
