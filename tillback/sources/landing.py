"""Delimited files in a landing folder: listing, typed loading and writing.

All fields are read as text by position, the null tokens are mapped, and then every field is cast
to its declared type. A row with too few or too many fields, or a value that does not fit its
type, fails the load as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillback.domains import KIND_TYPES, columns, kinds

# The file format. Compression is recognised by file ending.
CSV_FORMAT = {
    "sep": ",",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "FAILFAST",
    "columnPruning": "false",  # otherwise a count would not notice rows of the wrong length
}
NULL_TOKENS = ["", "NULL", "null"]
DATE_FORMATS = ["dd-MMM-yyyy", "MM/dd/yyyy"]
SWITCH_WORDS = {"on": "true", "off": "false"}


def text_schema(table: str) -> str:
    return ", ".join(f"{name} string" for name in columns(table))


def null_tokens(name: str) -> Column:
    return F.when(~F.trim(F.col(name)).isin(NULL_TOKENS), F.col(name))


def auto_date(text: Column) -> Column:
    """Date in ISO form or in one of the other accepted forms; anything else fails."""
    others = [F.try_to_date(text, form) for form in DATE_FORMATS]
    return F.coalesce(text.try_cast("date"), *others, text.cast("date"))


def typed(name: str, kind: str) -> Column:
    text = null_tokens(name)
    if kind == "date":
        return auto_date(text)
    if kind == "flag":
        word = F.lower(F.trim(text))
        for switch, value in SWITCH_WORDS.items():
            word = F.when(word == switch, value).otherwise(word)
        return word.cast("boolean")
    return text.cast(KIND_TYPES[kind])


def typed_rows(rows: DataFrame, table: str) -> DataFrame:
    """Text rows of a file source as raw table rows with their load metadata."""
    return rows.select(
        *[typed(name, kind).alias(name) for name, kind in kinds(table).items()],
        F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
        F.col("_metadata.file_name").alias("source_file"),
    )


def copy_into(spark: SparkSession, table: str, path: str, *, check_header: bool = False) -> DataFrame:
    """Raw rows of one table from a file, folder or glob.

    Fields are taken by position and the header is skipped; ``check_header`` also rejects files
    whose header names differ.
    """
    reader = spark.read.options(**CSV_FORMAT).schema(text_schema(table))
    return typed_rows(reader.option("enforceSchema", not check_header).csv(path), table)


def list_stage(spark: SparkSession, path: str) -> DataFrame:
    """Files below a landing folder with size and time; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "modificationTime")


def write_csv(df: DataFrame, path: str) -> None:
    """Header and rows as a folder of part files, written by all tasks."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
