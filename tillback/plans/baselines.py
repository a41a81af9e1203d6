"""Unusual return rates, told from an entity's own past and from its peers.

All sums are of whole numbers or decimals, and partial sums alone are moved: an entity with a third of
all rows is one row a day before any window sees it, and a peer group is three numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillback.functions.measures import RATE, count_rate, or_zero

# Days looked back on, and what makes a store stand out among its peers.
BASELINE_DAYS = 30
PEER_LIMIT = 2
PEER_MINIMUM = 3
RATE_UNITS = 1_000_000
WHOLE = "decimal(38,0)"


def daily_counts(sales: DataFrame, returns: DataFrame, entity: str) -> DataFrame:
    """(entity_id, activity_date, sales, returns) of every day with activity; rows without entity or date are left out."""
    sold = sales.select(F.col(entity).alias("entity_id"), F.col("sale_date").alias("activity_date"), F.lit(1).alias("s"), F.lit(0).alias("r"))
    back = returns.select(F.col(entity).alias("entity_id"), F.col("return_date").alias("activity_date"), F.lit(0).alias("s"), F.lit(1).alias("r"))
    both = sold.unionByName(back).filter("entity_id is not null and activity_date is not null")
    return both.groupBy("entity_id", "activity_date").agg(F.sum("s").alias("sales"), F.sum("r").alias("returns"))


def rolling_return_rate(sales: DataFrame, returns: DataFrame, entity: str, days: int = BASELINE_DAYS) -> DataFrame:
    """Each active day of an entity against the ``days`` before it.

    The window is a range of dates, not of rows: days without rows lie in it as days on which nothing
    was sold or returned, so ``baseline_returns_a_day`` divides by all of them. The baseline rate is
    that of the sums. A day is above it if its own rate is greater; equal rates and days or baselines
    without sales are not. The whole numbers are compared, not the rounded rates.
    """
    daily = daily_counts(sales, returns, entity)
    day = F.unix_date("activity_date")
    before = Window.partitionBy("entity_id").orderBy("day").rangeBetween(-days, -1)
    rolled = daily.withColumn("day", day).withColumns({
        "baseline_sales": or_zero(F.sum("sales").over(before)),
        "baseline_returns": or_zero(F.sum("returns").over(before)),
        "baseline_days": F.count("*").over(before),
    })

    def whole(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    above = (F.col("sales") > 0) & (F.col("baseline_sales") > 0) & (
        whole("returns") * whole("baseline_sales") > whole("baseline_returns") * whole("sales")
    )
    return rolled.select(
        F.lit(entity).alias("entity"), "entity_id", "activity_date", "sales", "returns",
        count_rate(F.col("returns"), F.col("sales")).alias("return_rate"),
        "baseline_sales", "baseline_returns", "baseline_days",
        count_rate(F.col("baseline_returns"), F.col("baseline_sales")).alias("baseline_rate"),
        count_rate(F.col("baseline_returns"), F.lit(days)).alias("baseline_returns_a_day"),
        above.alias("above_baseline"),
    )


def peer_scores(entities: DataFrame, key: str, group: str, part: str, whole: str) -> DataFrame:
    """How far each entity's rate ``part`` / ``whole`` lies from the mean of its group, in standard deviations.

    The rate is taken in millionths. A group's count, sum and sum of squares are added up, which can
    be done in any order and in parts, and joined back. Entities without a rate are no peers. Groups
    of one and groups without spread have no score; a score stands out from ``PEER_LIMIT`` on, in
    groups of ``PEER_MINIMUM`` or more. A group without a name is a group.
    """
    a, b = F.col(part).cast("decimal(20,0)"), F.col(whole).cast("decimal(20,0)")
    # rounded half up on whole numbers
    millionths = F.floor((a * 2 * RATE_UNITS + b) / F.nullif(b * 2, F.lit(0).cast("decimal(21,0)"))).cast("decimal(18,0)")
    rated = entities.select(key, F.col(group).alias("peer_group"), part, whole, millionths.alias("rate"))
    moments = rated.groupBy(F.col("peer_group").alias("_group")).agg(
        F.count("rate").alias("peers"), F.sum("rate").alias("_sum"), F.sum(F.col("rate") * F.col("rate")).alias("_squares")
    )
    joined = rated.join(moments, F.col("peer_group").eqNullSafe(F.col("_group")), "left")
    n = F.col("peers").cast("decimal(12,0)")
    joined = joined.withColumns({
        "_distance": (n * F.col("rate") - F.col("_sum")).cast("double"),
        "_spread": (n * F.col("_squares") - F.col("_sum") * F.col("_sum")).cast("double"),
    })
    count = F.col("peers").cast("double")
    score = F.col("_distance") * F.sqrt((count - 1) / count) / F.sqrt("_spread")
    score = F.when((F.col("peers") > 1) & (F.col("_spread") > 0), F.round(score, 4))
    return joined.select(
        key, "peer_group", "peers", part, whole,
        (F.col("rate") / F.lit(RATE_UNITS).cast("decimal(8,0)")).cast("decimal(12,6)").alias("rate"),
        (F.col("_sum") / F.nullif(n, F.lit(0)) / F.lit(RATE_UNITS).cast("decimal(8,0)")).cast(RATE).alias("peer_mean"),
        score.cast(RATE).alias("z_score"),
        F.coalesce((score >= PEER_LIMIT) & (F.col("peers") >= PEER_MINIMUM), F.lit(False)).alias("above_peers"),
    )
