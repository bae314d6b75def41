"""Run registered queries and their SQL side by side: ``python tools/check.py [--sf DIR] [name ...]``."""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from entries import oracle_sql, queries  # noqa: E402
from waybill.session import start  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value) if value is not None else None


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple((v is None, v or "") for v in r))


def compare(spark, con, name: str, folder: str) -> str:
    df = queries()[name](spark, folder)
    t0 = time.time()
    got = df.collect()
    took = time.time() - t0
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)} ({took:.2f}s, no SQL)"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows(df.columns, got), rows(columns, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"FAIL rows {len(a)} / {len(b)}, e.g. {sorted(columns)} {bad}"
    return f"ok {len(a)} rows ({took:.2f}s)"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = start("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("FATAL")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{args.sf}/{table}.parquet'")
    failed = 0
    for name in args.names or queries():
        try:
            outcome = compare(spark, con, name, args.sf)
        except Exception as error:  # noqa: BLE001
            outcome = f"FAIL {type(error).__name__} {str(error)[:600]}"
        failed += outcome.startswith("FAIL")
        print(f"{name}: {outcome}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
