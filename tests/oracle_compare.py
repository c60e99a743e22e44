"""Spark query vs DuckDB oracle: row count, column names and an order-insensitive
hash of the values (the same three checks the driver records).

CLI: ``python tests/oracle_compare.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ")
    return str(v)


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in RAW_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duckdb_connection(sf_dir)
    results: dict[str, dict] = {}
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        s = table_digest(df.columns, s_rows)
        t1 = time.time()
        res = {"spark_rows": s[0], "spark_sec": round(t1 - t0, 2)}
        if key in oracle:
            cur = con.execute(oracle[key])
            o_cols = [d[0] for d in cur.description]
            o = table_digest(o_cols, cur.fetchall())
            res.update(oracle_rows=o[0], rows_match=s[0] == o[0], schema_match=s[1] == o[1], hash_match=s[2] == o[2])
            if s[1] != o[1]:
                res["columns"] = (s[1], o[1])
        results[key] = res
        if verbose:
            print(key, res, flush=True)
    return results


if __name__ == "__main__":
    from crimestats.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    out = compare(spark, sf, keys)
    bad = [k for k, r in out.items() if not (r.get("hash_match") and r.get("schema_match") and r.get("rows_match"))]
    print("MISMATCH:", bad)
