"""Run Spark queries and their DuckDB oracle side by side (like the driver).

usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/oracle, column match, value match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from wardflow.plans import catalogue  # noqa: E402
from wardflow.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return norm(tuple(v))
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:12], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalogue.QUERIES)
    from wardflow.session import local_session
    extra = {}
    if os.environ.get("WARDFLOW_NO_BROADCAST"):
        # the plan shapes of a large cluster: no size-based broadcast, AQE
        # skew-join splitting on even small partitions
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    spark = local_session(8, 8, extra=extra)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = catalogue.QUERIES[n](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{n:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = catalogue.ORACLE.get(n)
        if sql is None:
            print(f"{n:32s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{n:32s} ORACLE ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        ok = (len(srows) == len(orows) and sorted(scols) == sorted(ocols) and hs == ho)
        bad += not ok
        print(f"{n:32s} rows={len(srows):7d}/{len(orows):7d} cols={'ok' if sorted(scols)==sorted(ocols) else 'DIFF'} "
              f"values={'ok' if hs == ho else 'DIFF'} {ts:.1f}s")
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   spark cols:", sorted(scols)); print("   oracle cols:", sorted(ocols))
            d1 = sorted(set(ls) - set(lo))[:3]
            d2 = sorted(set(lo) - set(ls))[:3]
            print("   spark only:", d1)
            print("   oracle only:", d2)
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
