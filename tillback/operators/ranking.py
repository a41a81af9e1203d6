"""Top rows, row numbering and exact quantiles that never sort a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBERING_BUCKETS = 16_384
CENTS_PER_BUCKET = 100_000


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every group. Meant for pre-aggregated rows, so that groups are small."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The ``k`` first rows of an order: every task keeps ``k`` rows and only those are merged."""
    return df.orderBy(*order).limit(k)


def number_members(
    df: DataFrame, order: str, group: str | None = None, buckets: int = NUMBERING_BUCKETS
) -> DataFrame:
    """Consecutive ``member_no`` (from 0) and ``member_count`` within each group.

    A group is spread over hash buckets of its members; bucket sizes give every bucket an offset,
    so a group holding a third of all rows is still numbered by many tasks. Without ``group`` the
    whole table is numbered. Members are ordered by bucket, then by ``order``.
    """
    # a text that is never null, so that the join below keeps the partitioning of the window
    group_key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")) if group else F.lit("")
    spread = df.withColumns({"_group": group_key, "_bucket": F.pmod(F.xxhash64(order), F.lit(buckets))})
    sizes = spread.groupBy("_group", "_bucket").agg(F.count("*").alias("_size"))
    by_group = Window.partitionBy("_group")
    before = by_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_group").alias("_offset_group"),
        F.col("_bucket").alias("_offset_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(by_group).alias("member_count"),
    )
    local = Window.partitionBy("_group", "_bucket").orderBy(order)
    numbered = spread.withColumn("_local", F.row_number().over(local) - 1)
    same_bucket = (F.col("_group") == F.col("_offset_group")) & (F.col("_bucket") == F.col("_offset_bucket"))
    return (
        numbered.join(offsets, same_bucket)
        .withColumn("member_no", F.col("_local") + F.col("_offset"))
        .drop("_group", "_bucket", "_offset_group", "_offset_bucket", "_offset", "_local")
    )


def exact_quantile(df: DataFrame, money: str, q: str) -> DataFrame:
    """One row ``value``: the interpolated ``q`` quantile (a decimal text) of a two-decimal column.

    Rows are first reduced to counts per distinct amount. Running counts are then built on two
    levels: per block of 100,000 cents, and inside a block, which therefore holds at most 100,000
    rows. The amounts at the two ranks around the quantile are picked by their running count.
    """
    cents = (F.col(money) * 100).cast("bigint")
    counts = (
        df.filter(F.col(money).isNotNull())
        .groupBy(cents.alias("cents")).agg(F.count("*").alias("n"))
        .withColumn("block", F.floor(F.col("cents") / CENTS_PER_BUCKET))
    )
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = blocks.select(
        "block",
        F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("start"),
        F.sum("block_n").over(everything).alias("total"),
    )
    inside = Window.partitionBy("block").orderBy("cents")
    ranked = counts.join(starts, "block").withColumns({
        "last": F.col("start") + F.sum("n").over(inside),
        "position": (F.col("total") - 1).cast("decimal(20,0)") * F.lit(q).cast("decimal(6,4)"),
    }).withColumn("first", F.col("last") - F.col("n"))

    def amount_at(rank: Column) -> Column:
        here = (F.col("first") <= rank) & (rank < F.col("last"))
        return F.max(F.when(here, F.col("cents"))).cast("decimal(20,0)")

    low_rank = F.floor("position")
    bounds = ranked.agg(
        amount_at(low_rank).alias("low"),
        amount_at(F.ceil("position")).alias("high"),
        F.max(F.col("position") - low_rank).cast("decimal(6,4)").alias("part"),
    )
    value = (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")) * F.lit("0.01").cast("decimal(3,2)")
    return bounds.select(value.cast("decimal(20,6)").alias("value"))
