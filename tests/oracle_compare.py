"""Run registered queries against their DuckDB oracles (as the driver does).

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import numpy as np

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        return round(f, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, np.datetime64):
        return str(np.datetime_as_string(v, unit="us"))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name: str, sf_dir: str, con=None, verbose=True) -> bool:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        if verbose:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {t1 - t0:.2f}s")
        return True
    res = con.sql(sql)
    dcols, drows = res.columns, res.fetchall()
    sc, sr = canon(sdf.columns, srows)
    dc, dr = canon(dcols, drows)
    ok = [c.lower() for c in sc] == [c.lower() for c in dc] and sr == dr
    if verbose:
        print(f"{name:28s} spark={len(sr):7d} duck={len(dr):7d} {'OK' if ok else 'MISMATCH'} "
              f"{t1 - t0:.2f}s")
        if not ok:
            print("   spark cols", sc)
            print("   duck  cols", dc)
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            print("   only spark", diff_s)
            print("   only duck ", diff_d)
    return ok


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from gridwave.session import build_session
    from __spark_entry__ import queries
    spark = build_session()
    con = duck(sf_dir)
    names = names or list(queries())
    bad = [n for n in names if not compare(spark, n, sf_dir, con)]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
