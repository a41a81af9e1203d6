"""Loading files all or nothing: one bad row rejects the landing and is reported with its file.

Files are read as text that may be malformed. The same job that writes the typed rows counts the rows
that do not fit; only without any are the rows committed. Otherwise a second pass over the landing
tells which files hold bad rows and what is wrong in them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillback.domains import KIND_TYPES, kinds
from tillback.sources.landing import CSV_FORMAT, DATE_FORMATS, SWITCH_WORDS, null_tokens, text_schema
from tillback.sources.versions import VersionedTables

MALFORMED = "_malformed"


class RejectedLanding(ValueError):
    """A landing with bad rows; ``report`` holds them by file."""

    def __init__(self, table: str, bad_rows: int, report: DataFrame):
        super().__init__(f"{bad_rows} bad rows for {table}; nothing was loaded")
        self.bad_rows = bad_rows
        self.report = report


@dataclass(frozen=True)
class _Field:
    name: str
    text: Column
    value: Column

    @property
    def fits(self) -> Column:
        return self.text.isNull() | self.value.isNotNull()


def _tried(name: str, kind: str) -> _Field:
    """A field's text and its value, null where it does not fit."""
    text = null_tokens(name)
    if kind == "date":
        return _Field(name, text, F.coalesce(text.try_cast("date"), *[F.try_to_date(text, form) for form in DATE_FORMATS]))
    if kind == "flag":
        word = F.lower(F.trim(text))
        for switch, value in SWITCH_WORDS.items():
            word = F.when(word == switch, value).otherwise(word)
        return _Field(name, text, word.try_cast("boolean"))
    return _Field(name, text, text.try_cast(KIND_TYPES[kind]))


def _read(spark: SparkSession, table: str, path: str) -> DataFrame:
    options = {**CSV_FORMAT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    rows = spark.read.options(**options).schema(f"{text_schema(table)}, {MALFORMED} string").option("enforceSchema", True).csv(path)
    return rows.withColumn("source_file", F.col("_metadata.file_name"))


def _problem(fields: list[_Field]) -> Column:
    """What is wrong with a row, or null."""
    wrong = [F.when(~field.fits, F.concat(F.lit(f"{field.name}: "), field.text)) for field in fields]
    return F.coalesce(F.when(F.col(MALFORMED).isNotNull(), F.concat(F.lit("fields: "), MALFORMED)), *wrong)


def bad_rows(spark: SparkSession, table: str, path: str) -> DataFrame:
    """(source_file, rows, bad_rows, example) of every file in a landing."""
    fields = [_tried(name, kind) for name, kind in kinds(table).items()]
    judged = _read(spark, table, path).withColumn("problem", _problem(fields))
    return judged.groupBy("source_file").agg(
        F.count("*").alias("rows"), F.count("problem").alias("bad_rows"), F.min("problem").alias("example")
    )


def load_all_or_nothing(spark: SparkSession, table: str, path: str, target: VersionedTables) -> int:
    """Replace ``table`` in ``target`` by the rows of a landing; the number of rows loaded.

    A landing with a bad row raises ``RejectedLanding`` and leaves the table as it was.
    """
    fields = [_tried(name, kind) for name, kind in kinds(table).items()]
    rows = _read(spark, table, path).withColumn("problem", _problem(fields))
    typed = rows.select(
        *[field.value.alias(field.name) for field in fields],
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"), "source_file", "problem",
    )
    with target.change() as change:
        change.write(table, typed, measures={"bad_rows": F.count("problem")})
        found = change.observed[table]["bad_rows"]
        if found:
            raise RejectedLanding(table, found, bad_rows(spark, table, path))
    return change.counts[table]
