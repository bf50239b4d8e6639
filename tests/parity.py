"""Run named queries on Spark and their SQL on DuckDB and compare every value.

``python tests/parity.py [sf_dir] [name-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def family(kind: str) -> str:
    """Type names of both engines on common ground."""
    kind = kind.upper()
    same = {
        "LONG": "BIGINT", "INTEGER": "INT", "STRING": "VARCHAR", "TIMESTAMP_NTZ": "TIMESTAMP",
    }
    return same.get(kind, kind)


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, decimal.Decimal):
        return (2, float(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return (3, value.isoformat())
    return (2, value) if isinstance(value, int) else (4, str(value))


def compare(df, con, sql: str) -> tuple[bool, str]:
    """Same columns, types, row count and bit-equal values, whatever the order."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, (family(str(t)) for t in rel.types)))
    ours = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    if set(ours) != set(theirs):
        return False, f"columns {sorted(set(ours) ^ set(theirs))}"
    names = sorted(ours)
    # A bare NULL or string length has no comparable type name.
    odd = [(n, ours[n], theirs[n]) for n in names if ours[n] != theirs[n]]
    left = sorted(tuple(canonical(r[n]) for n in names) for r in df.collect())
    at = [rel.columns.index(n) for n in names]
    right = sorted(tuple(canonical(r[i]) for i in at) for r in rel.fetchall())
    if len(left) != len(right):
        return False, f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            diff = [(n, x[1], y[1]) for n, x, y in zip(names, a, b) if x != y]
            return False, f"values {diff[:3]}"
    if odd:
        return False, f"types {odd}"
    return True, f"{len(left)} rows"


def main() -> int:
    from tidebook.catalog import ORACLE, QUERIES
    from tidebook.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name, build in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            ok, note = compare(df, con, ORACLE[name]) if name in ORACLE else (True, f"{df.count()} rows, no oracle")
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
