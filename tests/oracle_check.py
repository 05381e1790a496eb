"""Local twin of the driver's correctness gate.

Runs every ``queries()`` entry on Spark and its ``oracle_sql()`` twin in
DuckDB at one scale factor and compares row count, column names and an
order-insensitive multiset of rows (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def approx_equal(a, b, rel=1e-6):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, (float, int)) and y is not None:
                if not math.isclose(x, y, rel_tol=rel, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from panora.session import get_session
    import __spark_entry__ as E
    spark = get_session("oracle-check")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    ok = bad = 0
    for k, fn in qs.items():
        if pats and not any(p in k for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"ROWS {k}: {len(srows)} rows (no SQL twin) {ts:.2f}s")
            ok += 1
            continue
        try:
            res = con.execute(sqls[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"OK   {k}: {len(a)} rows {ts:.2f}s")
            ok += 1
        elif approx_equal(a, b):
            print(f"NEAR {k}: {len(a)} rows equal up to 1e-6 only")
            bad += 1
        else:
            print(f"FAIL {k}: rows spark={len(a)} duck={len(b)}")
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:3])
            print("   duck-only: ", list(sb - sa)[:3])
            bad += 1
    print(f"\n{ok} ok, {bad} failing")


if __name__ == "__main__":
    main()
