"""Display values: labels, recoded names and formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_or_id(name: str, key: str) -> Column:
    return F.coalesce(F.col(name), F.col(key))


def recode(column: Column, names: dict[str, str]) -> Column:
    """Replace known values; any other value stays."""
    table = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(table, column), column)


def format_number(column: Column) -> Column:
    return F.format_number(column, 0)


def format_money(column: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(column, 0))


def format_percent(column: Column) -> Column:
    return F.concat(F.format_number(column * 100, 1), F.lit("%"))


def spaced_title(column: Column) -> Column:
    """Underscores become spaces and every word starts upper-case."""
    return F.initcap(F.replace(column, F.lit("_"), F.lit(" ")))


def padded_id(prefix: str, number: Column, digits: int) -> Column:
    return F.format_string(f"{prefix}%0{digits}d", number)
