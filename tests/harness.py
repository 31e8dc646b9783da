"""Runs registered queries next to their SQL in DuckDB and compares the results exactly."""

from __future__ import annotations

import collections
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return type(value).__name__
    return type(value).__name__


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    bag = collections.Counter()
    kinds = collections.defaultdict(set)
    for row in rows:
        bag[tuple(plain(row[i]) for i in order)] += 1
        for i in order:
            if row[i] is not None:
                kinds[names[i]].add(kind(row[i]))
    return [names[i] for i in order], bag, dict(kinds)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def bad_shape(text: str) -> str | None:
    """Operators no registered query may need: joins without a key, row-at-a-time Python."""
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        if operator in text:
            return f"the plan has {operator}"
    return None


def compare(spark, con, fn, sql, sf):
    """(problem or None, row count, seconds)"""
    start = time.time()
    df = fn(spark, sf)
    text = plan_text(df)
    got = as_bag(df.columns, df.collect())
    seconds = time.time() - start
    result = con.execute(sql)
    want = as_bag([d[0] for d in result.description], result.fetchall())
    n = sum(got[1].values())
    if shape := bad_shape(text):
        return shape, n, seconds
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", n, seconds
    if got[1] != want[1]:
        only_got = list((got[1] - want[1]).items())[:3]
        only_want = list((want[1] - got[1]).items())[:3]
        return (
            f"rows {n} / {sum(want[1].values())}; only Spark: {only_got}; only SQL: {only_want}",
            n,
            seconds,
        )
    if got[2] != want[2]:
        return f"types {got[2]} != {want[2]}", n, seconds
    return None, n, seconds


if __name__ == "__main__":
    from conftest import build_session

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(e.queries())
    spark = build_session()
    con = duck(sf)
    bad = 0
    for name in names:
        fn, sql = e.queries()[name], e.oracle_sql().get(name)
        try:
            if sql is None:
                start = time.time()
                rows = fn(spark, sf).collect()
                print(f"rows  {name:26s} {len(rows):7d} {time.time() - start:6.2f}s", flush=True)
                continue
            problem, n, seconds = compare(spark, con, fn, sql, sf)
        except Exception as err:  # report and go on with the next query
            problem, n, seconds = f"{type(err).__name__}: {str(err)[:900]}", 0, 0.0
        bad += problem is not None
        print(f"{'FAIL ' if problem else 'ok   '} {name:26s} {n:7d} {seconds:6.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
