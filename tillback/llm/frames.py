"""Helpers that the text operators share: columns under private names, stored steps, array slices."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.sources.scratch import settled

SLICE_BYTES = 2_000_000
HOME = str(Path(__file__).resolve().parents[2])


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of a frame, written to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read of the stored rows, not the steps before them.
    """
    return settled(df, label)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def visible(df: DataFrame) -> DataFrame:
    """The same frame; Python workers of its session will look for this package where the driver found it."""
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if HOME not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, known]))
    return df


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key and text, with a null text read as an empty one."""
    return visible(docs).select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``limit`` bytes of text each (one row at least)."""
    offsets = text_offsets(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def text_offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of a text column's rows within its own data buffer."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[1], dtype=kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after the other, and where each row begins (one entry more than rows)."""
    offsets = text_offsets(column)
    data = column.buffers()[2] if len(column) else None
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def by_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"):
    """A function for mapInArrow that hands ``work`` one bounded slice at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)

    return run


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """List column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))
