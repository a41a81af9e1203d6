"""Shares of a total, with the total computed apart from the rows it divides."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_twice(df: DataFrame) -> DataFrame:
    """Keep an aggregated frame that is read by a scalar subquery and again by the rows it scales.

    Without this the subquery would scan the facts a second time. Lost blocks are recomputed.
    ``release`` gives the kept frames up again.
    """
    _kept.append(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_kept: list[DataFrame] = []


def release() -> int:
    """Give up all frames kept for a second reading, once the queries that read them have ended; their number."""
    frames = [_kept.pop() for _ in range(len(_kept))]
    for frame in frames:
        frame.unpersist()
    return len(frames)


def grand_total(df: DataFrame, measure: str) -> Column:
    """Sum over all rows as a scalar subquery, instead of a window over one huge partition."""
    return df.agg(F.sum(measure).alias("total")).scalar()


def share_within(df: DataFrame, group: str, weight: str, output: str) -> DataFrame:
    """``weight`` divided by its group's sum; group sums are aggregated first and joined back."""
    sums = df.groupBy(F.col(group).alias("_group")).agg(F.sum(weight).alias("_sum"))
    joined = df.join(sums, df[group].eqNullSafe(sums["_group"]))
    return joined.withColumn(output, F.col(weight) / F.col("_sum")).drop("_group", "_sum")
