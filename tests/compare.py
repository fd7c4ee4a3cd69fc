"""Runs registered queries against their DuckDB oracles: python tests/compare.py SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle_rows(con, sql: str):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return canonical(df.columns, df.collect())


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = spark_rows(fn(spark, sf_dir))
            took = time.time() - started
            if name not in oracles:
                print(f"ROWS  {name} {len(got[1])} rows {took:.1f}s", flush=True)
                continue
            want = oracle_rows(con, oracles[name])
            ok = got == want
            failed += not ok
            sql_took = time.time() - started - took
            print(f"{'OK   ' if ok else 'DIFF '} {name} {len(got[1])} rows {took:.1f}s sql {sql_took:.1f}s", flush=True)
            if not ok:
                print("   columns", got[0], want[0], len(got[1]), len(want[1]))
                only_got, only_want = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
                print("   spark only", len(only_got), [str(r)[:300] for r in sorted(only_got)[:2]])
                print("   sql only  ", len(only_want), [str(r)[:300] for r in sorted(only_want)[:2]])
        except Exception as error:  # report and go on with the next query
            failed += 1
            print(f"ERROR {name} {type(error).__name__} {str(error)[:700]}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
