"""Run registered queries and their SQL on the same tables and compare names, types and values.

usage: python tools/agree.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from registry import all_queries, all_sql  # noqa: E402
from trackspark import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return f"f{v!r}"
    if isinstance(v, bool):
        return f"b{v}"
    return f"{type(v).__name__}:{v}"


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name):
    started = time.time()
    df = all_queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    left = bag(df.columns, rows)
    sql = all_sql().get(name)
    if sql is None:
        return f"rows only ({len(rows)})", took
    result = con.execute(sql)
    right = bag([c[0] for c in result.description], result.fetchall())
    if left == right:
        return f"ok ({len(rows)})", took
    if left[0] != right[0]:
        return f"NAMES {left[0]} / {right[0]}", took
    extra, missing = left[1] - right[1], right[1] - left[1]
    text = f"VALUES {sum(left[1].values())} / {sum(right[1].values())} rows, {sum(extra.values())} differ"
    for label, part in (("spark", extra), ("sql", missing)):
        for row in list(part)[:2]:
            text += f"\n    {label}: " + " | ".join(f"{n}={v}" for n, v in zip(left[0], row))
    return text, took


def main():
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in args[1:] or all_queries():
        try:
            outcome, took = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            outcome, took = f"ERROR {type(error).__name__}: {str(error)[:700]}", 0.0
        bad += not outcome.startswith(("ok", "rows"))
        print(f"{name:36s} {took:6.2f}s  {outcome}", flush=True)
    print(f"{bad} of {len(args[1:] or all_queries())} disagree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
