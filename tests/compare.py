"""Run registered queries and their SQL side by side: python tests/compare.py [sf] [names...]."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    """One spelling per value, whichever engine it comes from."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, (int, float)):
        return format(decimal.Decimal(repr(round(value, 6))).normalize(), "f") if value else "0"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(r[i])) for i in order) for r in rows)


def compare(df, con, sql):
    """Return (rows, None) when both agree, else (rows, what differs)."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(set(df.columns) ^ set(names))}"
    if got == want:
        return len(got), None
    only_got, only_want = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return len(got), f"rows {len(got)} vs {len(want)}\n  spark {only_got}\n  sql   {only_want}"


def main() -> int:
    import __spark_entry__ as entry
    from granary.session import build_session

    sf_dir = os.path.join("/root/testdata", sys.argv[1] if len(sys.argv) > 1 else "sf0.01")
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.driver.maxResultSize": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                n, problem = compare(df, con, sqls[name])
            else:
                n, problem = len(df.collect()), None
        except Exception as error:
            n, problem = 0, f"{type(error).__name__}: {str(error)[:1200]}"
        mark = "FAIL" if problem else ("ok  " if name in sqls else "rows")
        print(f"{mark} {name:50s} {n:8d} rows {time.time() - began:6.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    missing = set(sqls) - set(entry.queries())
    print(f"{len(failed)} failed: {failed}; SQL without a query: {sorted(missing)}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
