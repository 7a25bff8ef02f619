"""Compare registered queries with their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=repr
    )


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    result = con.execute(sql)
    return table([c[0] for c in result.description], result.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            return f"{a}\n against\n{b}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from colloquy.plans.ordered_groups import HOT_ROWS_SETTING
    from colloquy.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, sqls = local_session(8), duck(sf_dir), oracle_sql()
    if "HOT_ROWS" in os.environ:  # cut every group above this many rows
        spark.conf.set(HOT_ROWS_SETTING, os.environ["HOT_ROWS"])
    print("without SQL:", sorted(set(queries()) - set(sqls)), "without query:", sorted(set(sqls) - set(queries())))
    for name in names:
        began = time.time()
        try:
            got = spark_table(queries()[name](spark, sf_dir))
            took = time.time() - began
            problem = difference(got, duck_table(con, sqls[name])) if name in sqls else None
            print(f"{name:28s} {took:6.2f}s {len(got[1]):7d} rows", "OK" if problem is None else "DIFFERENT " + problem[:600], flush=True)
        except Exception as error:
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:700]}", flush=True)
