"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [query ...]``. Compares row
count, column names and the sorted multiset of rows, values compared
exactly. Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    # Exact values: the registered queries round their statistics so both
    # engines agree to the last bit; only NaN and -0.0 are normalised.
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0:
            return 0.0
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        srows = [tuple(r) for r in df.collect()]
        dt = time.time() - t0
        if name not in sql:
            results[name] = ("rows-only", len(srows), dt)
            print(f"{name:40s} rows-only  spark={len(srows)}  {dt:.2f}s", flush=True)
            continue
        rel = con.sql(sql[name])
        dcols = rel.columns
        drows = rel.fetchall()
        # order columns by name like the driver does
        sidx = sorted(range(len(cols)), key=lambda i: cols[i])
        didx = sorted(range(len(dcols)), key=lambda i: dcols[i])
        s_sorted = [tuple(r[i] for i in sidx) for r in srows]
        d_sorted = [tuple(r[i] for i in didx) for r in drows]
        ok_cols = sorted(cols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        sk, dk = rows_key(s_sorted), rows_key(d_sorted)
        ok_v = sk == dk
        status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        results[name] = (status, len(srows), dt)
        print(f"{name:40s} {status:9s} spark={len(srows)} duck={len(drows)} cols={ok_cols} {dt:.2f}s",
              flush=True)
        if status != "OK":
            if not ok_cols:
                print("   spark cols", cols, "\n   duck cols ", dcols)
            in_s, in_d = set(sk), set(dk)
            diff_s = [r for r in sk if r not in in_d][:5]
            diff_d = [r for r in dk if r not in in_s][:5]
            print("   only spark:", diff_s)
            print("   only duck: ", diff_d)
    return results


if __name__ == "__main__":
    from keystat.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
