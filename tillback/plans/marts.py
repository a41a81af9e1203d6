"""Strict lane, last layer: the six marts.

Every function takes the fact columns it names and nothing else, so it can read the stored
enriched tables (only those columns are scanned) or the narrow frames before any dimension join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillback.domains import (
    HIGH_RETURN_MIN_RATE, HIGH_RETURN_MIN_UNITS, UNUSUAL_MIN_RETURNS, UNUSUAL_TIMES_AVERAGE,
)
from tillback.functions.measures import (
    MONEY_TOTAL, UNIT_TOTAL, count_rate, or_zero, quotient, settled,
)
from tillback.operators.joins import attach, totals_by_key
from tillback.operators.ranking import top_one
from tillback.operators.shares import grand_total, read_twice
from tillback.plans.intermediate import RETURN_FLAGS, STORE_CONTEXT

AVERAGE = "decimal(18,8)"


def _money(name: str) -> Column:
    return or_zero(F.col(name)).cast(MONEY_TOTAL)


def _number(flag: str) -> Column:
    return F.when(F.col(flag), 1).otherwise(0)


def _average_amount() -> Column:
    mean = F.sum("return_amount") / F.nullif(F.count("return_amount"), F.lit(0)).cast(UNIT_TOTAL)
    return mean.cast(AVERAGE)


def daily_sales_returns_summary(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sales by sale date next to returns by return date.

    Rows without a date still form a day of their own, but one on which nothing is counted.
    """
    def dated(day: str, value: Column) -> Column:
        return F.when(F.col(day).isNotNull(), value)

    days = totals_by_key(
        "calendar_date",
        (sales, "sale_date", {
            "sold": dated("sale_date", F.lit(1)),
            "sold_amount": dated("sale_date", F.col("net_sale_amount")),
        }),
        (returns, "return_date", {
            "refunded": dated("return_date", F.lit(1)),
            "refunded_amount": dated("return_date", F.col("return_amount")),
        }),
    )
    sold, refunded = or_zero(F.col("sold")), or_zero(F.col("refunded"))
    return days.select(
        "calendar_date",
        sold.alias("total_sales"),
        _money("sold_amount").alias("total_sales_amount"),
        refunded.alias("total_returns"),
        _money("refunded_amount").alias("total_return_amount"),
        or_zero(count_rate(refunded, sold)).cast("decimal(10,4)").alias("return_rate"),
        (_money("sold_amount") - _money("refunded_amount")).cast(MONEY_TOTAL)
        .alias("net_revenue_after_returns"),
    )


def reason_order() -> list[Column]:
    """Most frequent, then most costly, then first by name; unknown amounts first, names last."""
    return [
        F.desc("reason_return_count"),
        F.desc_nulls_first("reason_return_amount"),
        F.asc_nulls_last("return_reason"),
    ]


def reason_totals_by_product(returns: DataFrame) -> DataFrame:
    return returns.groupBy("product_id", "return_reason").agg(
        F.count("*").alias("reason_return_count"),
        F.sum("return_amount").alias("reason_return_amount"),
    )


def return_rate_by_product(products: DataFrame, sales_returns: DataFrame, returns: DataFrame) -> DataFrame:
    """Units and amounts sold and returned per listed product, and its leading return reason."""
    totals = sales_returns.groupBy("product_id").agg(
        F.sum("units_sold").alias("total_units_sold"),
        F.sum("net_sale_amount").alias("total_sales_amount"),
        F.sum("units_returned").alias("total_units_returned"),
        F.sum("return_amount").alias("total_return_amount"),
    )
    leading = top_one(reason_totals_by_product(returns), ["product_id"], reason_order())
    listed = attach(products, totals, "product_id", {name: name for name in totals.columns[1:]})
    listed = attach(listed, leading, "product_id", {"top_return_reason": "return_reason"})

    sold, back = or_zero(F.col("total_units_sold")), or_zero(F.col("total_units_returned"))
    share = quotient(back.cast(UNIT_TOTAL), F.col("total_units_sold").cast(UNIT_TOTAL))
    often = (sold >= HIGH_RETURN_MIN_UNITS) & (share >= F.lit(HIGH_RETURN_MIN_RATE).cast("decimal(4,2)"))
    return listed.select(
        "product_id", "product_name", "product_category", "product_subcategory", "brand",
        sold.cast(UNIT_TOTAL).alias("total_units_sold"),
        _money("total_sales_amount").alias("total_sales_amount"),
        back.cast(UNIT_TOTAL).alias("total_units_returned"),
        _money("total_return_amount").alias("total_return_amount"),
        or_zero(share).cast("decimal(10,4)").alias("return_rate"),
        settled(often).alias("high_return_product_flag"),
        "top_return_reason",
    )


def return_rate_by_store(stores: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Sales, returns and the share of exceptional returns per listed store."""
    totals = totals_by_key(
        "store_id",
        (sales, "store_id", {"total_sales": F.lit(1), "total_sales_amount": F.col("net_sale_amount")}),
        (returns, "store_id", {
            "total_returns": F.lit(1),
            "total_return_amount": F.col("return_amount"),
            "no_receipt": _number("no_receipt_flag"),
            "exceptional": _number("policy_exception_flag"),
        }),
    )
    listed = attach(stores, totals, "store_id", {name: name for name in totals.columns[1:]})
    count = {name: or_zero(F.col(name)) for name in ("total_sales", "total_returns", "no_receipt", "exceptional")}

    def share(part: str, whole: str) -> Column:
        return or_zero(count_rate(count[part], count[whole])).cast("decimal(10,4)")

    return listed.select(
        "store_id",
        *[F.col(source).alias(name) for name, source in STORE_CONTEXT.items()],
        count["total_sales"].alias("total_sales"),
        _money("total_sales_amount").alias("total_sales_amount"),
        count["total_returns"].alias("total_returns"),
        _money("total_return_amount").alias("total_return_amount"),
        share("total_returns", "total_sales").alias("return_rate"),
        share("no_receipt", "total_returns").alias("no_receipt_return_rate"),
        share("exceptional", "total_returns").alias("policy_exception_rate"),
    )


def return_reason_summary(returns: DataFrame) -> DataFrame:
    """Count, amount, share and average amount of the returns of each reason."""
    reasons = returns.groupBy("return_reason").agg(
        F.count("*").alias("total_returns"),
        F.sum("return_amount").cast(MONEY_TOTAL).alias("total_return_amount"),
        _average_amount().alias("average_return_amount"),
    )
    reasons = read_twice(reasons)
    all_returns = grand_total(reasons, "total_returns")
    return reasons.select(
        "return_reason", "total_returns", "total_return_amount",
        or_zero(count_rate(F.col("total_returns"), all_returns)).cast("decimal(10,4)").alias("percent_of_returns"),
        "average_return_amount",
    )


# Names of the exception reasons, in output order, and the output columns.
EXCEPTION_NAMES = {
    "late_return_flag": "late_return",
    "no_receipt_flag": "no_receipt",
    "damaged_or_defective_flag": "damaged_or_defective",
    "high_value_return_flag": "high_value_return",
}
RESIDUAL_EXCEPTION = "source_policy_exception"
EXCEPTION_COLUMNS = """
    return_id sale_id transaction_id sale_date return_date store_id store_name store_city
    store_region customer_id customer_loyalty_tier employee_id employee_role product_id
    product_name product_category product_subcategory return_quantity return_amount return_reason
    return_channel refund_method receipt_present item_condition days_until_return late_return_flag
    no_receipt_flag damaged_or_defective_flag high_value_return_flag policy_exception_flag
""".split()


def is_exceptional() -> Column:
    flags = [F.col(flag) for flag in RETURN_FLAGS]
    condition = flags[0]
    for flag in flags[1:]:
        condition = condition | flag
    return condition


def exception_reason() -> Column:
    """The names of all flags that hold, or the residual name when only the source raised one."""
    named = F.concat_ws(", ", *[F.when(F.col(flag), name) for flag, name in EXCEPTION_NAMES.items()])
    return F.when((named == "") & F.col("policy_exception_flag"), RESIDUAL_EXCEPTION).otherwise(named)


def exceptional_returns(returns: DataFrame) -> DataFrame:
    """Returns with at least one flag and their reason; context columns are kept if there are any."""
    return returns.filter(is_exceptional()).withColumn("exception_reason", exception_reason())


def return_policy_exceptions(returns: DataFrame) -> DataFrame:
    """Returns with at least one flag, at full detail."""
    return exceptional_returns(returns).select(*EXCEPTION_COLUMNS, "exception_reason")


def employee_return_activity(employees: DataFrame, returns: DataFrame) -> DataFrame:
    """Returns handled per listed employee; unusual ones reach twice the average over all listed."""
    handled = returns.groupBy("employee_id").agg(
        F.count("*").alias("total_returns_processed"),
        F.sum("return_amount").alias("total_return_amount_processed"),
        F.count_if("no_receipt_flag").alias("no_receipt_returns_processed"),
        F.count_if("policy_exception_flag").alias("policy_exception_returns_processed"),
        _average_amount().alias("average_return_amount"),
    )
    listed = attach(employees, handled, "employee_id", {name: name for name in handled.columns[1:]})
    activity = listed.select(
        "employee_id", "store_id", F.col("role").alias("employee_role"), "hire_date", "active_flag",
        or_zero(F.col("total_returns_processed")).alias("total_returns_processed"),
        _money("total_return_amount_processed").alias("total_return_amount_processed"),
        or_zero(F.col("no_receipt_returns_processed")).alias("no_receipt_returns_processed"),
        or_zero(F.col("policy_exception_returns_processed")).alias("policy_exception_returns_processed"),
        or_zero(F.col("average_return_amount")).cast(AVERAGE).alias("average_return_amount"),
    )
    activity = read_twice(activity)
    total = F.sum("total_returns_processed").cast(UNIT_TOTAL)
    average = activity.agg(quotient(total, F.count("*").cast(UNIT_TOTAL)).alias("average")).scalar()
    handled_count = F.col("total_returns_processed")
    unusual = (handled_count >= UNUSUAL_MIN_RETURNS) & (handled_count >= average * UNUSUAL_TIMES_AVERAGE)
    return activity.withColumn("unusual_return_activity_flag", unusual)
