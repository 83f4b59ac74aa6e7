"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def normalize(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=_key)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def compare(name: str, sdf, con, sql: str, rel_tol: float = 0.0) -> dict:
    t0 = time.time()
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    scols = sdf.columns
    t0 = time.time()
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    otypes = {d[0]: str(d[1]) for d in res.description}
    orows = res.fetchall()
    t_duck = time.time() - t0
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(orows), "spark_s": round(t_spark, 2),
           "duck_s": round(t_duck, 2)}
    out["columns_match"] = sorted(scols) == sorted(ocols)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    out["type_diffs"] = {c: (stypes[c], otypes.get(c)) for c in stypes if stypes[c] != otypes.get(c)}
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(scols) - set(ocols))
        out["oracle_only"] = sorted(set(ocols) - set(scols))
        out["values_match"] = False
        return out
    a = normalize(scols, srows)
    b = normalize(ocols, orows)
    out["values_match"] = a == b
    if not out["values_match"] and len(a) == len(b):
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["n_diff_rows"] = len(diffs)
        names = sorted(scols)
        if diffs:
            x, y = diffs[0]
            out["first_diff"] = {names[i]: (x[i], y[i]) for i in range(len(names)) if x[i] != y[i]}
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from demandlens.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs = queries()
    sqls = oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print({"name": name, "oracle": "none"})
            continue
        try:
            r = compare(name, fn(spark, sf_dir), con, sqls[name])
        except Exception as e:  # report and continue
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = r.get("values_match") and r.get("spark_rows") == r.get("oracle_rows")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
