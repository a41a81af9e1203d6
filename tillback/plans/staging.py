"""Strict lane, first layer: trimmed, typed rows; nothing is filtered or deduplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillback.functions.clean import STRICT, cleaned_columns

LOAD_METADATA = [
    "cast(loaded_at as timestamp_ntz) as loaded_at",
    "trim(source_file) as source_file",
]


def stage(raw: DataFrame, table: str) -> DataFrame:
    return raw.selectExpr(*cleaned_columns(table, STRICT), *LOAD_METADATA)


class Staged:
    """Lazy staged tables over any mapping of raw tables."""

    def __init__(self, raw):
        self._raw = raw

    def __getitem__(self, table: str) -> DataFrame:
        return stage(self._raw[table], table)
