"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and exits non-zero on any mismatch.
"""
from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in idx) for r in data)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from hirelake.plans.queries import ORACLES, QUERIES
    con = duck(sf_dir)
    bad = []
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            scols, srows = rows_of_spark(fn(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        t1 = time.time()
        if name not in ORACLES:
            print(f"rows {name}: {sum(srows.values())} rows (no oracle) spark {t1 - t0:.1f}s", flush=True)
            continue
        try:
            dcols, drows = rows_of_duck(con, ORACLES[name])
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name}: duckdb error {str(e)[:400]}", flush=True)
            continue
        ok = scols == dcols and srows == drows
        msg = f"{'ok  ' if ok else 'FAIL'} {name}: spark {sum(srows.values())} rows / oracle {sum(drows.values())}" \
              f" spark {t1 - t0:.1f}s"
        if not ok:
            bad.append(name)
            if scols != dcols:
                msg += f"\n   cols spark={scols}\n   cols duck ={dcols}"
            else:
                cut = lambda r: tuple(v[:60] if isinstance(v, str) else v for v in r)
                only_s = [cut(r) for r in list((srows - drows).elements())[:3]]
                only_d = [cut(r) for r in list((drows - srows).elements())[:3]]
                msg += f"\n   spark-only {only_s}\n   duck-only  {only_d}"
        print(msg, flush=True)
    return bad


if __name__ == "__main__":
    from hirelake.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = set(sys.argv[2:]) or None
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    failed = compare(spark, sf, names)
    print("FAILED:", failed if failed else "none")
    sys.exit(1 if failed else 0)
