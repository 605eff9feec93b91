"""Side-by-side check of registered queries against their DuckDB oracles (row count, schema, value hash).

Usage: ``python -m tablegrad.plans.verify [sf_dir] [key ...]``
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return "0.0"
        return repr(float(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return repr(v)


def _rows(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, sf_dir: str, key: str, con=None) -> dict:
    from tablegrad.plans.catalog import ORACLES, QUERIES
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    s_cols = sorted(sdf.columns)
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if key not in ORACLES:
        out["oracle"] = None
        return out
    rel = con.sql(ORACLES[key])
    d_cols = sorted(rel.columns)
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = s_cols == d_cols
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        return out
    a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
    out["hash_match"] = hashlib.sha1(repr(a).encode()).hexdigest() == hashlib.sha1(repr(b).encode()).hexdigest()
    out["types"] = {c: (type(s_rows[0][c]).__name__ if s_rows else None,
                        type(d_rows[0][c]).__name__ if d_rows else None) for c in s_cols}
    if not out["hash_match"]:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        out["n_diff"] = len(bad)
        out["example"] = bad[:2]
    return out


def main(argv):
    from tablegrad.plans.catalog import QUERIES
    from tablegrad.session import get_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    ok = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and continue
            r = {"key": k, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        good = r.get("hash_match") or (r.get("oracle", 1) is None and "error" not in r)
        ok += bool(good)
        print(("OK   " if good else "FAIL ") + str(r), flush=True)
    print(f"{ok}/{len(keys)} passed")


if __name__ == "__main__":
    main(sys.argv)
