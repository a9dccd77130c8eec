"""Run registered Spark queries against their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows after light normalisation (floats rounded, NaN as null).
"""

from __future__ import annotations

import argparse
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return cols, out


def duck(sf: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, con, name, fn, sql, sf):
    t0 = time.time()
    df = fn(spark, sf)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    msg = ""
    if sc != dc:
        msg = f"columns spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        msg = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        msg = f"values differ e.g. {diff}"
    return ok, len(sr), t1 - t0, msg


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--conf", action="append", default=[])
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from corpusprep.session import local_session
    import __spark_entry__ as E
    spark = local_session(8, 8)
    for k in a.conf:  # e.g. --conf key=value: a caller's session with other settings
        spark.conf.set(*k.split("=", 1))
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(a.sf)
    names = a.names or sorted(qs)
    bad = 0
    for n in names:
        if n not in orc:
            try:
                t0 = time.time()
                c = qs[n](spark, a.sf).count()
                print(f"ROWS  {n}: {c} rows ({time.time() - t0:.1f}s)")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {n}: {type(e).__name__}: {str(e)[:300]}")
            continue
        try:
            ok, nrows, secs, msg = check(spark, con, n, qs[n], orc[n], a.sf)
        except Exception as e:  # noqa: BLE001
            ok, nrows, secs, msg = False, -1, 0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += 0 if ok else 1
        print(f"{'OK   ' if ok else 'FAIL '} {n}: {nrows} rows ({secs:.1f}s) {msg}")
    print(f"{len(names) - bad}/{len(names)} passed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
