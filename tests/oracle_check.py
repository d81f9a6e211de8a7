"""Run registered queries in Spark and their SQL in DuckDB, compare like the driver.

usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row counts, column names and an order-insensitive hash of the values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemark.plans.registry import load_all  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.tables import DRIVER_TABLES  # noqa: E402


STRICT = os.environ.get("ORACLE_STRICT") == "1"   # exact float / decimal text, no rounding


def norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v) if STRICT else repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    reg = load_all()
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for k, e in reg.items():
        if keys and k not in keys:
            continue
        t0 = time.time()
        try:
            df = e.build(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not e.sql:
            print(f"rows {k}: {len(srows)} rows (no sql) {ts:.1f}s")
            continue
        try:
            res = con.execute(e.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        if len(srows) != len(drows) or hs != hd:
            bad += 1
            print(f"FAIL {k}: rows spark={len(srows)} duck={len(drows)}")
            a, b = set(ls), set(ld)
            for x in list(a - b)[:3]:
                print("   spark-only:", x[:300])
            for x in list(b - a)[:3]:
                print("   duck-only: ", x[:300])
        else:
            print(f"ok   {k}: {len(srows)} rows {ts:.1f}s")
    print("failures:", bad)


if __name__ == "__main__":
    main()
