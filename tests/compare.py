"""Run registered queries next to their checking SQL and compare rows exactly.

Usage: python tests/compare.py [data folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def check_engine(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def normal(value):
    return repr(value)


def sorted_rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(df, connection, statement: str) -> str:
    """Empty when both results agree, otherwise what differs."""
    names, rows = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(statement)
    other_names = [item[0] for item in cursor.description]
    other_names, other_rows = sorted_rows(other_names, cursor.fetchall())
    if names != other_names:
        return f"columns {sorted(set(names) ^ set(other_names))}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} against {len(other_rows)}"
    for row, other in zip(rows, other_rows):
        if row != other:
            return "; ".join(f"{n}: {a} against {b}" for n, a, b in zip(names, row, other) if a != b)
    return ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = check_engine(folder)
    queries, statements = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            if name in statements:
                problem = difference(queries[name](spark, folder), connection, statements[name])
            else:
                problem = "" if queries[name](spark, folder).collect() else "no rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "" if name in statements else " (no SQL)"
        print(f"{'FAIL' if problem else 'ok'} {name}{kind} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
