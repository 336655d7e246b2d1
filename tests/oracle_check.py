"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

    python tests/oracle_check.py [sf_dir] [query ...]

Rows are compared as multisets after sorting the columns by name; doubles must be equal.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "NO_ORACLE", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        out["status"] = "SCHEMA"
        out["detail"] = f"spark={sorted(scols)} oracle={sorted(dcols)}"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sset = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
    dset = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
    if sset == dset:
        out["status"] = "OK"
    else:
        out["status"] = "MISMATCH"
        sx, dx = set(sset), set(dset)
        out["detail"] = f"only_spark={list(sx - dx)[:3]} only_oracle={list(dx - sx)[:3]} cols={order}"
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as entry
    from graustein.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("OK", "NO_ORACLE")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
