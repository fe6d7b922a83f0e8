"""Local stand-in for the driver's correctness gate.

Runs ``queries()[name]`` on Spark and ``oracle_sql()[name]`` on DuckDB over the
same parquet directory and compares row count, column names and an
order-insensitive multiset of normalised rows.

    python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry

    qs = entry.queries()
    sql = entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        t1 = time.time()
        if name not in sql:
            results[name] = f"rows-only {len(s_rows)}"
            print(f"{name}: {results[name]} spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sql[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        t2 = time.time()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and a == b
        status = "OK" if ok else "MISMATCH"
        results[name] = status
        print(f"{name}: {status} rows spark={len(s_rows)} duck={len(d_rows)} "
              f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s", flush=True)
        if not ok and verbose:
            if not ok_cols:
                print("  cols spark-only", sorted(set(s_cols) - set(d_cols)),
                      "duck-only", sorted(set(d_cols) - set(s_cols)))
            else:
                only_s = list((a - b).elements())[:5]
                only_d = list((b - a).elements())[:5]
                print("  cols", sorted(s_cols))
                print("  spark-only", only_s)
                print("  duck-only ", only_d)
    return results


if __name__ == "__main__":
    sys.path.insert(0, os.getcwd())
    from ledgerlens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
