"""Compare every registered query with its DuckDB oracle (like the driver's gate).

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query and a summary; exit code 1 on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return f"{round(float(v), 6):.6f}"
    except Exception:
        pass
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return "rows-only", len(srows), t1 - t0, ""
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    if sc != dc:
        return "SCHEMA", len(srows), t1 - t0, f"spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return "ROWS", len(srows), t1 - t0, f"spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return "VALUES", len(srows), t1 - t0, str(diff)
    return "ok", len(srows), t1 - t0, ""


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from vigil.session import get_spark
    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            status, n, secs, info = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            status, n, secs, info = "ERROR", -1, 0.0, repr(e)[:600]
        if status not in ("ok", "rows-only"):
            bad += 1
        print(f"{status:9s} {name:40s} rows={n:7d} {secs:6.2f}s {info}", flush=True)
    print(f"mismatches: {bad} / {len(qs)}")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
