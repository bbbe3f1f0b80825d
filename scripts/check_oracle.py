"""Run every catalogue query in Spark and its oracle SQL in DuckDB; compare results.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Rows are compared as sorted multisets over the sorted column names; doubles are
rounded to 6 decimals first.
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shopstream.plans.catalog import QUERIES  # noqa: E402
from shopstream.plans.oracle import oracle_sql  # noqa: E402
from shopstream.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or list(QUERIES)
    spark = get_spark("local[8]", extra_conf={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        df = QUERIES[n](spark, sf)
        s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
        t1 = time.time()
        if n not in sqls:
            print(f"{n:28s} spark={len(s_rows):7d} (no oracle)")
            continue
        res = con.execute(sqls[n])
        d_cols = [c[0] for c in res.description]
        d_rows = rows_of(d_cols, res.fetchall())
        ok_cols = sorted(df.columns) == sorted(d_cols)
        ok = ok_cols and s_rows == d_rows
        bad += not ok
        print(f"{n:28s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={'ok' if ok_cols else 'DIFF'} "
              f"{'MATCH' if ok else 'MISMATCH'} {t1 - t0:.2f}s")
        if not ok:
            if not ok_cols:
                print("   spark cols", sorted(df.columns), "duck cols", sorted(d_cols))
            diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
            diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
            print("   spark-only", diff_s)
            print("   duck-only ", diff_d)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
