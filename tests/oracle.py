"""Compares a registered query with its SQL in DuckDB; also a command line tool.

    python tests/oracle.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None if value is None else "nan"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.6f}"
    return str(value)


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(_plain(r[i])) for i in order) for r in rows)


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, sf: str, name: str, function, sql: str | None):
    """``(ok, message, seconds)``"""
    start = time.time()
    df = function(spark, sf)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return len(got) > 0, f"rows={len(got)} (no SQL)", took
    con = connect(sf)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}", took
    left, right = table_rows(df.columns, got), table_rows(columns, want)
    if left == right:
        return True, f"rows={len(got)}", took
    diff = [(a, b) for a, b in zip(left, right) if a != b][:2]
    return False, f"rows {len(left)} vs {len(right)}; first differences {str(diff)[:600]}", took


def main() -> int:
    from corpuslab.plans.registry import ALL
    from corpuslab.session import build_session

    sf, names = sys.argv[1], sys.argv[2:] or list(ALL)
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        try:
            ok, message, took = compare(spark, sf, name, *ALL[name])
        except Exception:
            ok, message, took = False, traceback.format_exc()[-1500:], 0.0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {took:6.2f}s {message}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
