"""Run queries next to their SQL twins and compare whole results."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def compare(name, query, sql, spark, sf_dir):
    """(error text or None, rows, seconds)."""
    start = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(rows), took
    got_names, got = table_of(df.columns, rows)
    cur = connect(sf_dir).execute(sql)
    want_names, want = table_of([c[0] for c in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", len(rows), took
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2]
        only_want = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} vs {len(want)}; spark {only_got}; sql {only_want}", len(rows), took
    return None, len(rows), took


if __name__ == "__main__":
    from voxledger.session import local_session
    from voxledger.suite import all_oracles, all_queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    oracles = all_oracles()
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        try:
            error, n, took = compare(name, query, oracles.get(name), spark, sf_dir)
        except Exception as exc:  # report and go on
            error, n, took = f"{type(exc).__name__}: {str(exc)[:600]}", -1, 0.0
        print(f"{'FAIL' if error else 'ok  '} {name:26s} rows={n:<8d} {took:6.2f}s {'' if name in oracles else '(no sql)'} {(error or '')[:900]}", flush=True)
