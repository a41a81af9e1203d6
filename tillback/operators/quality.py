"""Data-quality checks as Spark jobs: violating rows, and one summary row per check.

Summaries have the columns rule, table_name, column_name, rows_checked and violations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY = ["rule", "table_name", "column_name", "rows_checked", "violations"]


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Known values that occur more than once, with their number of rows."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows")).filter("rows > 1")


def unaccepted_rows(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Rows with a known value outside the list."""
    return df.filter(~F.col(column).isin(accepted))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Known child keys without a parent, with their number of rows.

    Child rows are counted per key before the anti join, so a frequent key moves as one row.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(key).alias("key")), on="key", how="left_anti")


def negative_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def before_rows(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose ``later`` date lies before the ``earlier`` one; unknown dates do not count."""
    return df.filter(F.col(later) < F.col(earlier))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def row_checks(df: DataFrame, table: str, rule: str, violated: dict[str, Column]) -> DataFrame:
    """Summary of row conditions (column name -> violation) of one table in a single scan."""
    counts = df.agg(
        F.count("*").alias("rows_checked"),
        *[F.count_if(condition).alias(f"v{i}") for i, condition in enumerate(violated.values())],
    )
    entries = [
        F.struct(F.lit(column).alias("column_name"), F.col(f"v{i}").alias("violations"))
        for i, column in enumerate(violated)
    ]
    rows = counts.select("rows_checked", F.explode(F.array(*entries)).alias("entry"))
    return rows.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "entry.column_name",
        "rows_checked", "entry.violations",
    )


def not_null(df: DataFrame, table: str, names: list[str]) -> DataFrame:
    return row_checks(df, table, "not_null", {name: F.col(name).isNull() for name in names})


def accepted_values(df: DataFrame, table: str, accepted: dict[str, list[str]]) -> DataFrame:
    return row_checks(df, table, "accepted_values", {name: ~F.col(name).isin(v) for name, v in accepted.items()})


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of repeated known values, found from one count per value."""
    per_value = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    repeated = F.col("value").isNotNull() & (F.col("n") > 1)
    return per_value.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"), F.count_if(repeated).alias("violations")
    ).select(F.lit("unique").alias("rule"), F.lit(table).alias("table_name"),
             F.lit(column).alias("column_name"), "rows_checked", "violations")


def relationships(child: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Number of rows whose known key has no parent, with keys counted before the join."""
    keys = child.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(key).alias("parent_key")).distinct()
    matched = keys.join(known, keys["key"] == known["parent_key"], "left")
    orphan = F.col("key").isNotNull() & F.col("parent_key").isNull()
    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("violations"),
    ).select(F.lit("relationships").alias("rule"), F.lit(table).alias("table_name"),
             F.lit(column).alias("column_name"), "rows_checked", "violations")


def not_empty(df: DataFrame, table: str) -> DataFrame:
    """One violation when the table has no row at all."""
    counted = df.agg(F.count("*").alias("rows_checked"))
    return counted.select(
        F.lit("not_empty").alias("rule"), F.lit(table).alias("table_name"), F.lit("*").alias("column_name"),
        "rows_checked", F.when(F.col("rows_checked") == 0, 1).otherwise(0).cast("bigint").alias("violations"),
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as one job over all of them, ordered by name."""
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in frames.items()
    ]
    return union_all(counts).orderBy("table_name")


def column_report(frames: dict[str, DataFrame], expected: dict[str, list[str]]) -> DataFrame:
    """Per table: whether its ordered columns are the expected ones, and its rows."""
    reports = [
        frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(frame.columns == expected[name]).alias("columns_match"),
            "row_count",
        )
        for name, frame in frames.items()
    ]
    return union_all(reports)


def forbidden_columns(df: DataFrame, tokens: list[str]) -> list[str]:
    """Column names that contain one of the tokens."""
    return [name for name in df.columns if any(token in name.lower() for token in tokens)]


def require_rows(**frames: DataFrame) -> None:
    """Fail when a needed input has no row."""
    empty = [name for name, frame in frames.items() if frame.isEmpty()]
    if empty:
        raise ValueError(f"no rows in: {', '.join(empty)}")


def failed(summary: DataFrame) -> DataFrame:
    return summary.filter("violations > 0")
