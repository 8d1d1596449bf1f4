"""Run registered queries on Spark and DuckDB side by side and compare names, types and values.

    python tools/check_oracle.py [sf_dir] [name or prefix* ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from loglattice.registry import CASES
from loglattice.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date, decimal.Decimal)):
        return str(value)
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, con, case, sf_dir):
    started = time.time()
    df = case.run(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    if case.sql is None:
        return seconds, len(mine), "no-oracle"
    result = con.execute(case.sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return seconds, len(mine), f"columns {sorted(set(names) ^ set(df.columns))}"
    wrong = {n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t, t) != types[n]}
    if wrong:
        return seconds, len(mine), f"types {wrong}"
    a, b = rows(df.columns, mine), rows(names, theirs)
    if a == b:
        return seconds, len(mine), "ok"
    only_a = [x for x in a if x not in set(b)][:3]
    only_b = [x for x in b if x not in set(a)][:3]
    return seconds, len(mine), f"rows {len(a)} vs {len(b)}\n   cols  {sorted(names)}\n   spark {only_a}\n   duck  {only_b}"


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for case in CASES:
        if args and not any(case.name == a or (a.endswith("*") and case.name.startswith(a[:-1])) for a in args):
            continue
        try:
            seconds, count, verdict = compare(spark, con, case, sf_dir)
        except Exception as e:
            seconds, count, verdict = 0, 0, f"error {type(e).__name__}: {str(e)[:1200]}"
        good = verdict in ("ok", "no-oracle") and count > 0
        bad += not good
        print(f"{'OK ' if good else 'BAD'} {case.name:<34} {count:>6} rows {seconds:6.2f}s  {verdict}", flush=True)
    print(f"{bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
