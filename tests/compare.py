"""Runs queries against their SQL in DuckDB: python tests/compare.py SF_DIR NAME..."""

from __future__ import annotations

import glob
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if glob.glob(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def rows(columns: list[str], values: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(v[i] for i in order)) for v in values)


def same(spark, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = connect(sf_dir).execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows(df.columns, [tuple(r) for r in got]), rows(names, want)
    if a != b:
        only_a, only_b = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        return f"{len(a)} and {len(b)} rows; only in Spark {only_a}; only in SQL {only_b}"
    return None


def main(sf_dir: str, names: list[str]) -> None:
    import time

    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[4]").config("spark.driver.memory", "6g").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = e.queries(), e.oracle_sql()
    for n in names or queries:
        began = time.time()
        if n in sql:
            print(n, same(spark, queries[n], sql[n], sf_dir) or "same", f"{time.time() - began:.1f} s", flush=True)
        else:
            df = queries[n](spark, sf_dir)
            print(n, "no SQL", df.schema.simpleString(), df.count(), f"{time.time() - began:.1f} s", flush=True)
            df.show(5)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    main(sys.argv[1], sys.argv[2:])
