"""Runs registered queries and their SQL on the same tables and compares the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "__float__") and not isinstance(value, (bool, int)):
        return round(float(value), 9)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, query, sql, folder):
    started = time.time()
    df = query(spark, folder)
    got = df.collect()
    spent = time.time() - started
    mine, left = rows(df.columns, [tuple(r) for r in got])
    cursor = con.execute(sql)
    theirs, right = rows([d[0] for d in cursor.description], cursor.fetchall())
    problem = None
    if mine != theirs:
        problem = f"columns {mine} / {theirs}"
    elif len(left) != len(right):
        problem = f"{len(left)} rows / {len(right)}"
    elif left != right:
        problem = next(f"{a} / {b}" for a, b in zip(left, right, strict=True) if a != b)
    return len(left), spent, problem


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from recurra.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(folder), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            count, spent, problem = compare(spark, con, name, query, sql[name], folder)
        except Exception as error:  # report and go on with the next query
            count, spent, problem = 0, 0.0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{count:8}{spent:8.2f}s  {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
