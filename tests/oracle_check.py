"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (floats rounded to 6 places, or exact with ORACLE_EXACT=1). Prints
one line per query.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(v) if os.environ.get("ORACLE_EXACT") else f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def table_hash(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as e

    qs, sql = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        res = {"rows": len(rows), "spark_s": round(t1 - t0, 2)}
        if name in sql:
            cur = con.execute(sql[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            res.update(
                oracle_rows=len(orows),
                cols_match=sorted(cols) == sorted(ocols),
                hash_match=sorted(cols) == sorted(ocols) and table_hash(cols, rows) == table_hash(ocols, orows),
            )
            if not res["cols_match"]:
                res["cols"] = (cols, ocols)
        out[name] = res
    return out


if __name__ == "__main__":
    from punctuality.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n, r in compare(spark, sf, names).items():
        ok = r.get("hash_match", True) and r.get("rows") == r.get("oracle_rows", r.get("rows"))
        bad += not ok
        print(("OK  " if ok else "FAIL"), n, r, flush=True)
    print("failures:", bad)
