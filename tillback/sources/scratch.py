"""Shared scratch folders for data that is written and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Folders taken inside ``passing_folders``, which deletes them.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@lru_cache(maxsize=1)
def _own_folder() -> str:
    """A folder of this process, for local sessions that name none; it is deleted when the process ends."""
    folder = tempfile.mkdtemp(prefix="tillback-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one the cluster names for checkpoints.

    Only a local session without that setting gets a temporary folder of its own process.
    """
    base = spark.conf.get(SHARED_FOLDER, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SHARED_FOLDER} to a folder that all executors can reach")
        base = _own_folder()
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (passing := _PASSING.get()) is not None:
        passing.append(folder)
    return folder


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Folders that are taken inside are deleted at the end: what was made of their rows has been stored elsewhere."""
    taken: list[str] = []
    token = _PASSING.set(taken)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for folder in taken:
            delete_folder(spark, folder)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside deletes its shuffle files when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def write_rows(df: DataFrame, path: str, *partition_by: str) -> None:
    """Add the rows of a frame to a folder; the shuffles that made them are gone afterwards."""
    with passing_shuffles(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and go on from the stored rows.

    Used where later steps read a frame several times; the stored rows also outlive lost executors.
    """
    path = shared_folder(df.sparkSession, label)
    write_rows(df, path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def settled_in_turn(frames: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all frames, which have one schema, stored one frame after the other: shuffles take the disk of one at a time."""
    path, schema = None, None
    for frame in frames:
        path = path or shared_folder(frame.sparkSession, label)
        write_rows(frame, path)
        spark, schema = frame.sparkSession, frame.schema
    kept = spark.read.schema(schema).parquet(path)
    kept.stored_at = path
    return kept


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files of settled frames that nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, frame.stored_at)
