"""Run registered queries in Spark and their oracle SQL in DuckDB on the
same parquet tables; compare row count, column names and an
order-insensitive multiset of normalised values.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(_norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(srows)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows_raw = cur.fetchall()
    idx = {c: i for i, c in enumerate(dcols)}
    res["oracle_rows"] = len(drows_raw)
    if sorted(dcols) != sorted(scols):
        res["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return res
    drows = [tuple(_norm(r[idx[c]]) for c in sorted(dcols)) for r in drows_raw]
    cs, cd = Counter(srows), Counter(drows)
    if cs == cd:
        res["status"] = "match"
    else:
        res["status"] = "MISMATCH"
        res["spark_only"] = list((cs - cd).elements())[:3]
        res["oracle_only"] = list((cd - cs).elements())[:3]
    return res


def main():
    from parcelflow.session import build_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session()
    con = duck_conn(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t = time.time()
        try:
            r = compare(spark, name, fn, oracle.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
