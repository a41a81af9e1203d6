"""Facts and marts by day that are brought up to date instead of rebuilt.

Sales are stored by the period (day, week, month, quarter or year) of their sale date, returns by that of their
return date, both also by batch, so that loading a batch again replaces its own rows. A batch affects
the periods of its rows; a late sale also affects the periods of the returns that refer to it, as it gives them a
sale date. Only partitions of affected periods are read and written. A period that is not affected keeps
its files and the number of the batch that built it. The period should be chosen so that it holds some
files' worth of rows.

The affected periods are collected: their number is bounded by the calendar, not by the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillback.operators.joins import likely_met
from tillback.plans.intermediate import return_flags, return_timing, sale_measures
from tillback.plans.marts import daily_sales_returns_summary, exception_reason, is_exceptional

SALE_DAY, RETURN_DAY = "sale_date", "return_date"
PERIOD = "period"
# The columns of returns that the two marts read.
RETURN_COLUMNS = """return_id sale_id return_date return_amount return_reason no_receipt_flag damaged_or_defective_flag
    high_value_return_flag policy_exception_flag""".split()
EXCEPTION_COLUMNS = """return_id sale_id sale_date days_until_return return_amount return_reason late_return_flag no_receipt_flag
    damaged_or_defective_flag high_value_return_flag policy_exception_flag exception_reason""".split()


def in_periods(periods: Iterable[dt.date | None]) -> Column:
    """Whether a row lies in one of the periods; None stands for rows without a date."""
    known = [period for period in periods if period is not None]
    found = F.coalesce(F.col(PERIOD).isin(known), F.lit(False)) if known else F.lit(False)
    return found | F.col(PERIOD).isNull() if None in periods else found


def replace_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Write the partitions that occur in ``df``; all others stay. Rows of a large partition are written by several tasks."""
    dealt = df.hint("rebalance", *[F.col(key) for key in keys])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


class DailyTables:
    """Facts and daily marts below a folder, in partitions of a day or of a longer ``grain``."""

    def __init__(self, spark: SparkSession, base: str, grain: str = "day"):
        self._spark = spark
        self._base = base.rstrip("/")
        self._grain = grain
        self._schemas: dict[str, str] = {}

    def _period(self, day: str) -> Column:
        return (F.col(day) if self._grain == "day" else F.trunc(day, self._grain)).alias(PERIOD)

    def read(self, name: str) -> DataFrame:
        reader = self._spark.read
        return (reader.schema(self._schemas[name]) if name in self._schemas else reader).parquet(f"{self._base}/{name}")

    def _replace(self, name: str, df: DataFrame, *keys: str) -> None:
        ordered = df.select(*[c for c in df.columns if c not in keys], *keys)
        self._schemas[name] = ordered.schema
        replace_partitions(ordered, f"{self._base}/{name}", *keys)

    def apply(self, sales: DataFrame, returns: DataFrame, batch: int) -> list[dt.date | None]:
        """Take in the staged rows of a batch and rebuild the affected periods; these, in order, None first.

        The batch is read twice, for its periods and to be stored; from then on its stored rows are read.
        """
        sold = sale_measures(sales).select("sale_id", SALE_DAY, "net_sale_amount", self._period(SALE_DAY))
        back = return_flags(returns).select(*RETURN_COLUMNS, self._period(RETURN_DAY))
        of_sales, own = ({row[0] for row in rows.select(PERIOD).distinct().collect()} for rows in (sold, back))
        number = F.lit(batch)
        self._replace("sales", sold.withColumn("batch", number), PERIOD, "batch")
        self._replace("returns", back.withColumn("batch", number), PERIOD, "batch")

        # returns of any batch whose sale has just come
        returned = self.read("returns").select("sale_id", PERIOD)
        come = self.read("sales").filter(in_periods(of_sales) & (F.col("batch") == batch)).select("sale_id")
        waiting = returned.join(likely_met(come, "sale_id", returned), "sale_id", "left_semi") if of_sales else returned.limit(0)
        of_returns = own | {row[0] for row in waiting.select(PERIOD).distinct().collect()}
        of_rows = of_sales | own
        if of_rows:
            self._replace("daily", self._daily(of_rows).withColumn("built_by", number), PERIOD)
        if of_returns:
            self._replace("exceptions", self._exceptions(of_returns).withColumn("built_by", number), PERIOD)
        return sorted(of_rows | of_returns, key=lambda period: (period is not None, period or dt.date.min))

    def _daily(self, periods: set) -> DataFrame:
        sales, returns = (self.read(name).filter(in_periods(periods)) for name in ("sales", "returns"))
        return daily_sales_returns_summary(sales, returns).withColumn(PERIOD, self._period("calendar_date"))

    def _exceptions(self, periods: set) -> DataFrame:
        """Exceptional returns of the periods. A return's sale may lie on any day, so all stored sales are asked by id."""
        returns = self.read("returns").filter(in_periods(periods))
        sold = likely_met(self.read("sales").select("sale_id", SALE_DAY), "sale_id", returns)
        found = return_timing(returns, sold)
        found = found.withColumn("exceptional", is_exceptional()).withColumn("exception_reason", exception_reason())
        kept = found.filter("exceptional").select(PERIOD, RETURN_DAY, *EXCEPTION_COLUMNS)
        # a period without any exceptional return must lose its rows: it keeps one without a return
        blank = [F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in (RETURN_DAY, *EXCEPTION_COLUMNS)]
        return kept.unionByName(found.select(PERIOD).distinct().select(PERIOD, *blank))

    def daily(self) -> DataFrame:
        return self.read("daily").drop(PERIOD)

    def exceptions(self) -> DataFrame:
        return self.read("exceptions").filter("exception_reason is not null").drop(PERIOD)
