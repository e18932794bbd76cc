"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [key ...]

Compare rule (like the driver's): columns sorted by name, same row count, same column
names, and the same multiset of rows after normalising values (floats rounded).
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from feedloom.plans import oracle_sql, queries  # noqa: E402
from feedloom.plans.tables import TABLES  # noqa: E402
from feedloom.session import build_session  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (dt.datetime,)):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", type=int, default=3)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    keys = a.keys or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"rows {k}: spark {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        sc, sl = digest(scols, srows)
        dc, dl = digest(dcols, drows)
        ok = sc == dc and sl == dl
        h = hashlib.sha1("\n".join(sl).encode()).hexdigest()[:8]
        if ok:
            print(f"ok   {k}: {len(sl)} rows {h} {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {k}: cols {sc} vs {dc}; rows {len(sl)} vs {len(dl)}")
            only_s = sorted(set(sl) - set(dl))[: a.show]
            only_d = sorted(set(dl) - set(sl))[: a.show]
            for x in only_s:
                print("   spark :", x[:400])
            for x in only_d:
                print("   duckdb:", x[:400])
    print(f"{len(keys) - bad}/{len(keys)} passed")
    spark.stop()


if __name__ == "__main__":
    main()
