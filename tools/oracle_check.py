"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]

Prints one line per key: OK / MISMATCH / ERROR / ROWS (no oracle), with
row counts. Values are compared order-insensitively after sorting columns
by name; floats are compared at 1e-6 relative precision.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerlake.plans.catalog import load_all  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402
from ledgerlake.sources.tables import TABLE_NAMES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, repr(x)) for x in r))
    return [cols[i] for i in order], out


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint",
                 "TINYINT": "tinyint", "FLOAT[]": "array<float>", "VARCHAR[]": "array<string>"}


def duck_type(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return DUCK_TO_SPARK.get(t, t)


def duck(sf_dir: str):
    con = duckdb.connect()
    for n in TABLE_NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf_dir}/{n}.parquet')")
    return con


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    reg = load_all()
    keys = a.keys or sorted(reg)
    spark = build_session("local[8]", 8)
    con = duck(a.sf)
    bad = 0
    for k in keys:
        q = reg[k]
        t0 = time.time()
        try:
            df = q.run(spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR    {k}: spark {type(e).__name__}: {str(e)[:300]}")
            traceback.print_exc(limit=2)
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS     {k}: spark={len(srows)} ({ts:.2f}s)")
            continue
        try:
            cur = con.execute(q.sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            rel = con.sql(q.sql)
            dtypes = dict(zip(rel.columns, [duck_type(x) for x in rel.types]))
            stypes = dict(df.dtypes)
            tdiff = {c: (stypes.get(c), dtypes.get(c)) for c in dtypes if stypes.get(c) != dtypes.get(c)}
            if tdiff:
                print(f"TYPES    {k}: {tdiff}")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR    {k}: duckdb {type(e).__name__}: {str(e)[:300]}")
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        if sc != dc:
            bad += 1
            print(f"MISMATCH {k}: columns spark={sc} duck={dc}")
            continue
        if sr != dr:
            bad += 1
            ds, ss = set(dr), set(sr)
            diff_s = [r for r in sr if r not in ds][:3]
            diff_d = [r for r in dr if r not in ss][:3]
            print(f"MISMATCH {k}: rows spark={len(sr)} duck={len(dr)}\n   spark-only {diff_s}\n   duck-only  {diff_d}")
            continue
        print(f"OK       {k}: rows={len(sr)} ({ts:.2f}s)")
    print(f"done: {len(keys)} keys, {bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
