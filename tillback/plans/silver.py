"""Lenient lane, second layer: cleaned rows and their measures; unreadable values become null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillback.domains import LENIENT_HIGH_VALUE, PRIMARY_KEYS
from tillback.functions.clean import LENIENT, clean_table
from tillback.functions.measures import days_between, is_damaged, is_late

# The amount of a fact that must not be negative.
AMOUNTS = {"sales": "sale_amount", "returns": "return_amount"}
CLEANED_POLICY = "cleaned_policy_exception_flag"


def cleaned(bronze: DataFrame, table: str) -> DataFrame:
    """Cleaned rows that have a key and, for a fact, no negative amount; an unknown amount stays."""
    kept = f"length(trim(cast({PRIMARY_KEYS[table]} as string))) > 0"
    if table in AMOUNTS:
        kept += f" and coalesce(try_cast({AMOUNTS[table]} as double) >= 0, true)"
    return clean_table(bronze.filter(kept), table, LENIENT)


def silver_sales(bronze_sales: DataFrame) -> DataFrame:
    gross = F.round(F.col("quantity") * F.col("unit_price"), 2)
    discount = F.coalesce(F.col("discount_amount"), F.lit(0.0))
    priced = cleaned(bronze_sales, "sales").withColumn("gross_sale_amount", gross)
    known = F.col("gross_sale_amount")
    return priced.withColumns({
        "net_sale_amount": F.round(known - discount, 2),
        "discount_rate": F.when(known > 0, F.round(discount / known, 4)),
    })


def silver_returns(bronze_returns: DataFrame, sales: DataFrame) -> DataFrame:
    """Cleaned returns with their sale's date; an orphan keeps unknown timing."""
    rows = cleaned(bronze_returns, "returns").withColumnRenamed("policy_exception_flag", CLEANED_POLICY)
    dated = rows.join(sales.select("sale_id", "sale_date"), on="sale_id", how="left")
    days: Column = days_between("sale_date", "return_date")
    return dated.withColumns({
        "days_until_return": days,
        "late_return_flag": is_late(days),
        "no_receipt_flag": ~F.col("receipt_present"),
        "damaged_or_defective_flag": is_damaged(
            F.col("item_condition"), F.col("return_reason"), inside_words=True
        ),
        "high_value_return_flag": F.col("return_amount") >= LENIENT_HIGH_VALUE,
    })


class Silver:
    """Lazy silver tables over any mapping of bronze tables."""

    def __init__(self, bronze):
        self._bronze = bronze

    def __getitem__(self, table: str) -> DataFrame:
        if table == "sales":
            return silver_sales(self._bronze["sales"])
        if table == "returns":
            return silver_returns(self._bronze["returns"], cleaned(self._bronze["sales"], "sales"))
        return cleaned(self._bronze[table], table)
