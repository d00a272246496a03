"""Run catalogue queries on Spark and their SQL on DuckDB; report matches.

Usage: python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((norm(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def rows_key(r):
    return tuple((x is None, str(type(x)), str(x)) for x in r)


def compare(spark_rows, cols_s, duck_rows, cols_d):
    if sorted(cols_s) != sorted(cols_d):
        return f"columns differ: {cols_s} vs {cols_d}"
    idx = [cols_d.index(c) for c in cols_s]
    a = sorted((tuple(norm(x) for x in r) for r in spark_rows), key=rows_key)
    b = sorted((tuple(norm(r[i]) for i in idx) for r in duck_rows), key=rows_key)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    return None


def main(argv):
    sys.path.insert(0, ".")
    from ordo.plans.catalog import ORACLES, QUERIES
    from ordo.session import get_spark
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = get_spark(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    con = duck(sf_dir)
    fails = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            fails += 1
            continue
        ts = time.time() - t0
        if n not in ORACLES:
            print(f"ROWS {n}: {len(rows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(ORACLES[n])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            fails += 1
            continue
        msg = compare(rows, cols, drows, dcols)
        if msg:
            fails += 1
            print(f"FAIL {n}: {msg}")
        else:
            print(f"OK   {n}: {len(rows)} rows ({ts:.1f}s)")
    print(f"{len(names) - fails}/{len(names)} ok")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
