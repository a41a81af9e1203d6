"""Reshaping, filtering and projection helpers of the report layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names without surrounding spaces or quotes, in lower case."""
    return df.toDF(*[name.strip().strip('"').lower() for name in df.columns])


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [name for name in wanted if name not in df.columns]


def require_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    missing = missing_columns(df, wanted)
    if missing:
        raise ValueError(f"missing columns {missing}; available columns {df.columns}")
    return df


def project_or_all(df: DataFrame, wanted: list[str], rows: int | None = None) -> tuple[DataFrame, list[str]]:
    """The wanted columns, or the whole frame with the list of missing ones."""
    missing = missing_columns(df, wanted)
    picked = df if missing else df.select(*wanted)
    return (picked if rows is None else picked.limit(rows)), missing


def filter_isin(df: DataFrame, column: str, chosen: list[str] | None) -> DataFrame:
    """Rows whose value was chosen; choosing nothing keeps every row."""
    return df.filter(F.col(column).isin(list(chosen))) if chosen else df


def contains_any(column: str, parts: list[str]) -> Column:
    """True when any literal part occurs in the text; an unknown text contains none."""
    found = reduce(lambda left, right: left | right, [F.col(column).contains(part) for part in parts])
    return F.coalesce(found, F.lit(False))


def filter_contains_any(df: DataFrame, column: str, parts: list[str] | None) -> DataFrame:
    return df.filter(contains_any(column, list(parts))) if parts else df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct known values."""
    return df.select(column).dropna().distinct().orderBy(column)


def explode_counts(df: DataFrame, column: str, item: str, count: str, separator: str = ", ") -> DataFrame:
    """Rows per listed item; counted by whole list first, so that only distinct lists are split."""
    lists = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    items = lists.select(F.explode(F.split(column, separator)).alias(item), "_n")
    return items.groupBy(item).agg(F.sum("_n").alias(count)).orderBy(F.desc(count), F.asc(item))


def split_tokens(df: DataFrame, column: str, item: str, separator: str = ",") -> DataFrame:
    """Sorted distinct tokens of a separated list column, without blanks."""
    parts = F.transform(F.split(column, separator), lambda part: F.trim(part))
    tokens = df.select(column).distinct().select(F.explode(parts).alias(item))
    return tokens.filter(F.col(item) != "").distinct().orderBy(item)


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)
