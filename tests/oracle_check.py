"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of rows
(exact values; floats compared bit for bit). Prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import duckdb

    import __spark_entry__ as E
    from mercato.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols, s_rows = df.columns, df.collect()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(s_rows):7d} (no oracle) spark={ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        same = ok_cols and a == b
        bad += not same
        msg = "OK " if same else "MISMATCH"
        print(f"{name:28s} {msg} rows spark={len(s_rows)} duck={len(d_rows)} spark={ts:.1f}s")
        if not ok_cols:
            print("   cols spark:", sorted(s_cols), "\n   cols duck: ", sorted(d_cols))
        elif not same:
            only_s, only_d = a - b, b - a
            print("   spark-only:", list(only_s.items())[:3])
            print("   duck-only: ", list(only_d.items())[:3])
            print("   sorted cols:", sorted(s_cols))
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
