"""Runs every registered query against its SQL counterpart: python tests/compare.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked)


def differences(spark_rows, sql_rows) -> str:
    """Empty when both results are equal, else a short account of how they differ."""
    (left_columns, left), (right_columns, right) = spark_rows, sql_rows
    if left_columns != right_columns:
        return f"columns {left_columns} / {right_columns}"
    if left == right:
        return ""
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return (
        f"rows {len(left)} / {len(right)}, only left {len(only_left)} {only_left[:2]}, "
        f"only right {len(only_right)} {only_right[:2]}"
    )


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as registry
    from dwellmart.session import build_session

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, statements, failed = connect(folder), registry.oracle_sql(), 0
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        found = query(spark, folder)
        left = normal(found.columns, [tuple(row) for row in found.collect()])
        took = time.time() - start
        if name not in statements:
            print(f"rows {name} {len(left[1])}")
            continue
        answer = con.execute(statements[name])
        right = normal([c[0] for c in answer.description], answer.fetchall())
        verdict = differences(left, right)
        failed += bool(verdict)
        print(f"{'DIFF' if verdict else 'ok  '} {name} {len(left[1])} rows {took:.2f}s {verdict}")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
