"""Run registered queries and their DuckDB twins side by side (like the driver).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in records), key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        scols = df.columns
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows), None)
            if verbose:
                print(f"{name:32s} rows-only  spark={len(srows)}  {t1-t0:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        results[name] = ("match" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{name:32s} {'match' if ok else 'MISMATCH'}  spark={len(srows)} duck={len(drows)}"
                  f"  {t1-t0:.1f}s", flush=True)
            if not ok:
                if not ok_cols:
                    print("   cols", sorted(scols), sorted(dcols))
                else:
                    sa, sb = set(a), set(b)
                    print("   only spark:", list(sa - sb)[:3])
                    print("   only duck: ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from quarry.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    spark = get_spark()
    res = compare(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
