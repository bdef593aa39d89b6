"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive multiset of rows.

usage: python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tabsieve.plans import catalog  # noqa: E402
from tabsieve.plans.tables import TABLES  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, keys=None, verbose=True):
    reg = catalog.registry()
    con = duck(sf_dir)
    results = {}
    for key, (fn, sql) in reg.items():
        if keys and key not in keys:
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[key] = ("SPARK_ERROR", repr(e)[:300])
            print(key, results[key], flush=True)
            continue
        t1 = time.time()
        if sql is None:
            results[key] = ("ROWS_ONLY", len(sp))
            print(f"{key:24s} rows-only n={len(sp)} spark={t1-t0:.1f}s", flush=True)
            continue
        try:
            dk = con.execute(sql).fetchdf()
        except Exception as e:  # noqa: BLE001
            results[key] = ("SQL_ERROR", repr(e)[:300])
            print(key, results[key], flush=True)
            continue
        c1, r1 = rows_of(sp)
        c2, r2 = rows_of(dk)
        if c1 != c2:
            status = ("COLS", c1, c2)
        elif len(r1) != len(r2):
            status = ("COUNT", len(r1), len(r2))
        elif r1 != r2:
            bad = [(a, b) for a, b in zip(r1, r2) if a != b]
            status = ("VALUES", len(bad), bad[:3])
        else:
            status = ("OK", len(r1))
        results[key] = status
        print(f"{key:24s} {status[0]} {status[1:] if status[0] != 'OK' else status[1]} "
              f"spark={t1-t0:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from tabsieve.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    ks = sys.argv[2:] or None
    res = check(get_spark(master="local[*]", shuffle_partitions=8, driver_memory="16g"), sf, ks)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print("FAILED:", sorted(bad) if bad else "none")
