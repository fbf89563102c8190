"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return [cols[i] for i in order], out


def compare(spark, con, key, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok_cols = sc == dc
    ok_rows = len(sr) == len(dr)
    ok_vals = ok_cols and sr == dr
    detail = ""
    if not ok_vals:
        if not ok_cols:
            detail = f"cols spark={sc} duck={dc}"
        else:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            detail = f"rows {len(sr)} vs {len(dr)}; first diffs {diff}"
    return ok_cols and ok_rows and ok_vals, len(sr), ts, detail


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as E
    from hazrank.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    n_ok = 0
    for k in (keys or sorted(qs)):
        if k not in orc:
            if os.environ.get("SKIP_ROWS_ONLY"):
                continue
            df = qs[k](spark, sf_dir)
            print(f"ROWS-ONLY {k}: {df.count()} rows", flush=True)
            continue
        try:
            ok, n, ts, detail = compare(spark, con, k, qs[k], orc[k], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, detail = False, -1, 0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        n_ok += ok
        print(f"{'OK  ' if ok else 'FAIL'} {k}: rows={n} spark={ts:.1f}s {detail}", flush=True)
    print(f"{n_ok}/{len([k for k in (keys or qs) if k in orc])} match")


if __name__ == "__main__":
    main()
