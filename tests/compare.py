"""Runs registered queries in Spark and their SQL in DuckDB, and compares all rows."""

from __future__ import annotations

import datetime
import decimal
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


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    return names, sorted(rows, key=sort_key)


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return sorted(names), sorted(rows, key=sort_key)


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from meterhouse.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            mine = spark_rows(run(spark, folder))
            took = time.time() - began
            if name not in oracle:
                print(f"rows  {name}: {len(mine[1])} rows {took:.2f}s", flush=True)
                continue
            verdict = difference(mine, duck_rows(con, oracle[name]))
        except Exception as e:  # report and go on with the next query
            verdict, took = f"{type(e).__name__}: {str(e)[:1500]}", time.time() - began
            mine = ([], [])
        failed += verdict is not None
        print(f"{'FAIL' if verdict else 'ok  '}  {name}: {len(mine[1])} rows {took:.2f}s "
              f"{time.time() - began - took:.2f}s {verdict or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
