"""Compare each registered query with its DuckDB oracle, the way the driver does:
row count, column names, and an order-insensitive hash of the values.

    python -m tests.oracle_check [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

sys.path.insert(0, ".")
import __spark_entry__ as E  # noqa: E402
from answercheck.sources.tables import TABLE_NAMES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 else v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from answercheck.session import build_session
    spark = build_session("local[8]")
    qs, oracles = E.queries(), E.oracle_sql()
    keys = args.keys or list(qs)
    con = duck(args.sf)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, args.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in oracles:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(oracles[k])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        a, b = canon(scols, srows), canon(dcols, drows)
        if len(a) != len(b) or a != b:
            diff = [x for x in a if x not in set(b)][:3]
            diff2 = [x for x in b if x not in set(a)][:3]
            print(f"FAIL {k}: rows spark={len(a)} duck={len(b)} spark-only={diff} duck-only={diff2}")
            bad += 1
        else:
            print(f"OK   {k}: {len(a)} rows {ts:.1f}s")
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
