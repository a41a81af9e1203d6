"""A history of loads: one row per table and load, compared with the loads before.

Counts and newest dates are observed while a load is written, so no table is read to be counted. The
history is partitioned by load and table, and a load that is recorded again replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillback.functions.measures import rate

# Loads in the trailing mean, the change that is reported, and hours after which a table is stale.
TRAILING_LOADS = 7
CHANGE_LIMIT = "0.5000"
STALE_HOURS = 36

HISTORY = "load_no int, table_name string, row_count bigint, newest_load timestamp_ntz"


def record_load(spark: SparkSession, history: str, load_no: int, observed: Mapping[str, Mapping]) -> None:
    """Append what was observed of every table of a load (row_count, newest_load): one row a table."""
    rows = [(load_no, name, seen["row_count"], seen["newest_load"]) for name, seen in sorted(observed.items())]
    found = spark.createDataFrame(rows, HISTORY).coalesce(1)
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_no", "table_name").parquet(history)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(history)


def load_trend(history: DataFrame, as_of, trailing: int = TRAILING_LOADS) -> DataFrame:
    """Every load next to the mean of up to ``trailing`` loads before it, and how old its newest rows are.

    The first load of a table has no mean and no change. ``as_of`` is a timestamp column or text.
    """
    before = Window.partitionBy("table_name").orderBy("load_no").rowsBetween(-trailing, -1)
    now = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    summed = history.withColumns({
        "earlier_loads": F.count("*").over(before), "_rows": F.sum("row_count").over(before),
        "rows_since": F.col("row_count") - F.lag("row_count").over(Window.partitionBy("table_name").orderBy("load_no")),
    })
    mean = (F.col("_rows").cast("decimal(20,0)") / F.nullif(F.col("earlier_loads"), F.lit(0)).cast("decimal(10,0)")).cast("decimal(24,4)")
    # the change in rows times loads, so that no rounded mean enters the comparison
    change = rate(
        (F.col("row_count") * F.col("earlier_loads") - F.col("_rows")).cast("decimal(20,0)"), F.col("_rows").cast("decimal(20,0)")
    )
    hours = F.timestamp_diff("HOUR", F.col("newest_load"), now)
    return summed.select(
        "load_no", "table_name", "row_count", "earlier_loads", "rows_since", mean.alias("trailing_mean"), change.alias("change"),
        F.coalesce(F.abs(change) > F.lit(CHANGE_LIMIT).cast("decimal(10,4)"), F.lit(False)).alias("unusual_count"),
        hours.alias("age_hours"), F.coalesce(hours > STALE_HOURS, F.lit(True)).alias("stale"),
    )
