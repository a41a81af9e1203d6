"""Cleaning expressions for the two lanes, as SQL text per column kind.

The strict lane trims and casts; a value that does not fit its type fails the job. The lenient
lane lower-cases all text and turns whatever it cannot read into null. Text keeps plan building
cheap: a table is one ``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillback.domains import FALSE_WORDS, KIND_TYPES, TRUE_WORDS, kinds


def _words(words: list[str]) -> str:
    return ", ".join(f"'{word}'" for word in words)


LOWER_TEXT = "nullif(lower(trim(cast({c} as string))), '')"

STRICT = {
    "text": "trim({c})",
    "label": "lower(trim({c}))",
    "code": "upper(trim({c}))",
    **{kind: f"cast({{c}} as {KIND_TYPES[kind]})" for kind in ("date", "count", "money", "flag")},
}

LENIENT = {
    "text": LOWER_TEXT,
    "label": LOWER_TEXT,
    "code": LOWER_TEXT,
    "date": "try_cast(cast({c} as string) as date)",
    "count": "try_cast({c} as int)",
    "money": "try_cast({c} as double)",
    "flag": (
        f"case when lower(trim(cast({{c}} as string))) in ({_words(TRUE_WORDS)}) then true"
        f" when lower(trim(cast({{c}} as string))) in ({_words(FALSE_WORDS)}) then false end"
    ),
}


def cleaned_column(rules: dict[str, str], kind: str, name: str) -> Column:
    """One cleaned column outside of a table, e.g. ``cleaned_column(LENIENT, "date", "day")``."""
    return F.expr(rules[kind].format(c=name))


def cleaned_columns(table: str, rules: dict[str, str]) -> list[str]:
    """One cleaned output expression per declared column of ``table``."""
    return [f"{rules[kind].format(c=name)} as {name}" for name, kind in kinds(table).items()]


def clean_table(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    return df.selectExpr(*cleaned_columns(table, rules))


def as_bool(name: str) -> Column:
    """Two-valued reading of a boolean or of its text form; anything unknown is false."""
    return F.expr(f"coalesce({LOWER_TEXT.format(c=name)} in ({_words(TRUE_WORDS)}), false)")
