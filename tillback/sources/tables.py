"""Named tables: namespaces, checked identifiers, writing by overwrite and reading back."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMAT = "parquet"
IDENTIFIER = re.compile(r"[A-Z0-9_$]+")


def layer_schema(custom: str | None, target: str) -> str:
    """Schema of a layer: its own one if given, otherwise the target's."""
    return target if custom is None else custom.strip()


def checked_identifier(name: str) -> str:
    clean = name.strip().upper()
    if not IDENTIFIER.fullmatch(clean):
        raise ValueError(f"not a plain identifier: {name!r}")
    return clean


def qualified(*parts: str) -> str:
    """Dotted table name of checked parts."""
    return ".".join(checked_identifier(part) for part in parts)


def create_namespace(spark: SparkSession, *names: str, location: str | None = None) -> None:
    """Schemas by name, in the warehouse or below ``location``."""
    for name in names:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


@contextmanager
def passing_namespace(spark: SparkSession, prefix: str, location: str) -> Iterator[str]:
    """A schema of its own name below ``location``, which is dropped with its tables at the end."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    create_namespace(spark, name, location=location)
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def write_overwrite(
    df: DataFrame, table: str, *, fmt: str = FORMAT, bucket_by: str | None = None, buckets: int = 0
) -> None:
    """Replace a table. Bucketing by a key lets later joins and distinct counts on it stay in place.

    Rows are moved to their bucket before writing, which gives one file per bucket instead of one
    per task and bucket; use it for keys that identify rows. Rows without a key share a bucket but
    are written by all tasks.
    """
    if not (bucket_by and buckets):
        df.write.format(fmt).mode("overwrite").saveAsTable(table)
        return
    place = F.col(bucket_by)
    if isinstance(df.schema[bucket_by].dataType, T.StringType):
        place = F.coalesce(place, F.xxhash64(*df.columns).cast("string"))
    placed = df.repartition(buckets, place)
    writer = placed.write.format(fmt).mode("overwrite")
    writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(table)


def copy_to_bronze(spark: SparkSession, sources: Mapping[str, str], prefix: str, fmt: str = FORMAT) -> dict[str, str]:
    """Copy source tables unchanged to ``<prefix>.bronze_<name>`` and return the new names."""
    targets = {}
    for name, source in sources.items():
        targets[name] = f"{prefix}.bronze_{name}"
        write_overwrite(spark.table(source), targets[name], fmt=fmt)
    return targets


def read_mart(spark: SparkSession, *parts: str) -> DataFrame:
    """Stored mart by name parts; names are checked before they reach the catalogue."""
    return spark.table(qualified(*parts))


def publish_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames available to SQL text under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def show(df: DataFrame, rows: int = 50) -> None:
    df.show(rows, truncate=False)
