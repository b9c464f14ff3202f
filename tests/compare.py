"""Runs registered queries against DuckDB on the same files: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, sf_dir: str) -> tuple[int, str | None]:
    """Row count, and what differs if anything does."""
    df = query(spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    wanted = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(found), f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(found) != len(wanted):
        return len(found), f"{len(found)} rows != {len(wanted)}"
    for a, b in zip(found, wanted):
        if a != b:
            return len(found), f"{a} != {b}"
    return len(found), None


if __name__ == "__main__":
    import __spark_entry__ as spark_entry
    from sluicegate.session import build_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "sf0.01"), sys.argv[2:]
    sf_dir = f"{TESTDATA}/{sf}"
    session = build_session(
        "compare",
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    other, oracles, failed = duck(sf_dir), spark_entry.oracle_sql(), 0
    for name, query in spark_entry.queries().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            if name in oracles:
                n, problem = compare(session, other, query, oracles[name], sf_dir)
            else:
                n, problem = query(session, sf_dir).count(), None
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{n:8} {time.time() - begun:6.2f}s {problem or ''}", flush=True)
    session.stop()
    sys.exit(failed)
