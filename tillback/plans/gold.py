"""Lenient lane, last layer: six marts assembled from one catalogue of metrics.

A mart is a key, the dimension it describes, and the names of the metrics wanted on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillback.functions.measures import rounded_sum, safe_rate
from tillback.operators.distinct import FIRST_MARKS, marked_count, repeats_by
from tillback.operators.joins import attach, full_merge
from tillback.plans.silver import CLEANED_POLICY

# Metric names of the marts.
SALE_METRICS = {
    "sale_count": lambda: F.countDistinct("sale_id"),
    "units_sold": lambda: F.sum("quantity"),
    "gross_sales_amount": lambda: rounded_sum("gross_sale_amount"),
    "net_sales_amount": lambda: rounded_sum("net_sale_amount"),
    "recorded_sales_amount": lambda: rounded_sum("sale_amount"),
}
RETURN_METRICS = {
    "return_count": lambda: F.countDistinct("return_id"),
    "units_returned": lambda: F.sum("return_quantity"),
    "return_amount": lambda: rounded_sum("return_amount"),
    "avg_days_until_return": lambda: F.round(F.avg("days_until_return"), 2),
    "late_return_count": lambda: F.count_if("late_return_flag"),
    "no_receipt_return_count": lambda: F.count_if("no_receipt_flag"),
    "damaged_or_defective_return_count": lambda: F.count_if("damaged_or_defective_flag"),
    "policy_exception_count": lambda: F.count_if(CLEANED_POLICY),
    "high_value_return_count": lambda: F.count_if("high_value_return_flag"),
}


# The columns of silver facts that marts without context read.
SALE_COLUMNS = """sale_id sale_date store_id product_id employee_id quantity sale_amount gross_sale_amount
    net_sale_amount""".split()
RETURN_COLUMNS = ["return_id", "return_date", "store_id", "product_id", "employee_id", "return_quantity", "return_amount",
                  "return_reason", "days_until_return", "late_return_flag", "no_receipt_flag", "damaged_or_defective_flag",
                  "high_value_return_flag", CLEANED_POLICY]


# What distinct returns are counted by, and the column that each mart groups by.
COUNTED_BY = {
    "return_date": "return_date", "product_id": "product_id", "store_id": "store_id", "employee_id": "employee_id",
    "return_reason": "coalesce(return_reason, 'unknown')",
}


class Counted:
    """Stored sales whose rows of repeated ids are known: distinct ids are rows with an id, less those of repeated ids."""

    def __init__(self, facts: DataFrame, repeated: DataFrame | None):
        self.facts = facts
        self.repeated = repeated

    def metrics_by(self, key: str, names: str) -> DataFrame:
        metrics = {name: SALE_METRICS[name]() for name in names.split()} | {"sale_count": F.count("sale_id")}
        sums = self.facts.groupBy(key).agg(*[metric.alias(name) for name, metric in metrics.items()])
        if self.repeated is None:
            return sums
        over = repeats_by(self.repeated, key, "sale_id")
        joined = sums.join(over, F.col(key).eqNullSafe(F.col("_key")), "left")
        return joined.withColumn("sale_count", F.col("sale_count") - F.coalesce("_over", F.lit(0))).drop("_key", "_over")


def metrics_by(facts: DataFrame, key: Column, catalogue: dict, names: str, counted: str = "") -> DataFrame:
    """The named metrics per key.

    Counting distinct ids moves each id once to find repeats. Sales stored bucketed by their id lie
    that way already. Returns that carry marks for ``counted`` have them added up, and only partial
    sums move.
    """
    metrics = {name: catalogue[name]() for name in names.split()}
    if "return_count" in metrics and counted and FIRST_MARKS in facts.columns:
        metrics["return_count"] = marked_count(list(COUNTED_BY).index(counted))
    return facts.groupBy(key).agg(*[metric.alias(name) for name, metric in metrics.items()])


def with_rates(mart: DataFrame) -> DataFrame:
    return mart.withColumns({
        "return_rate_by_units": safe_rate(F.col("units_returned"), F.col("units_sold")),
        "return_rate_by_amount": safe_rate(F.col("return_amount"), F.col("net_sales_amount")),
    })


def _mart(key: str, dimension: DataFrame | None, sales: DataFrame | Counted, returns: DataFrame,
          sale_names: str, return_names: str, sale_key: str = "", return_key: str = "") -> DataFrame:
    """Dimension, sales and returns merged on ``key``: unknown keys stay, with null attributes."""
    if isinstance(sales, Counted):
        sold = sales.metrics_by(sale_key or key, sale_names).withColumnRenamed(sale_key or key, key)
    else:
        sold = metrics_by(sales, F.col(sale_key or key).alias(key), SALE_METRICS, sale_names)
    sides = [
        sold,
        metrics_by(returns, F.col(return_key or key).alias(key), RETURN_METRICS, return_names, return_key or key),
    ]
    if dimension is not None:
        sides.insert(0, dimension)
    return with_rates(full_merge(key, *sides, zeros=sale_names.split() + return_names.split()))


def gold_daily_sales_returns_summary(sales: DataFrame, returns: DataFrame) -> DataFrame:
    return _mart(
        "activity_date", None, sales, returns,
        "sale_count units_sold gross_sales_amount net_sales_amount recorded_sales_amount",
        "return_count units_returned return_amount late_return_count no_receipt_return_count"
        " high_value_return_count",
        sale_key="sale_date", return_key="return_date",
    )


def gold_return_rate_by_product(products: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    return _mart(
        "product_id", products, sales, returns,
        "sale_count units_sold gross_sales_amount net_sales_amount",
        "return_count units_returned return_amount damaged_or_defective_return_count"
        " high_value_return_count",
    )


def gold_return_rate_by_store(stores: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    return _mart(
        "store_id", stores, sales, returns,
        "sale_count units_sold net_sales_amount",
        "return_count units_returned return_amount late_return_count no_receipt_return_count"
        " policy_exception_count",
    )


def gold_employee_return_activity(employees: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    return _mart(
        "employee_id", employees, sales, returns,
        "sale_count units_sold net_sales_amount",
        "return_count units_returned return_amount late_return_count no_receipt_return_count"
        " policy_exception_count high_value_return_count",
    )


def gold_return_reason_summary(returns: DataFrame) -> DataFrame:
    """All return metrics per reason; a missing reason is called unknown."""
    reason = F.coalesce("return_reason", F.lit("unknown")).alias("return_reason")
    return metrics_by(returns, reason, RETURN_METRICS, " ".join(RETURN_METRICS), "return_reason")


# Context and output columns of the exception table.
GOLD_CONTEXT = [
    ("products", "product_id", {
        name: name for name in ("product_name", "product_category", "product_subcategory", "brand")
    }),
    ("stores", "store_id", {
        name: name for name in ("store_name", "city", "province", "region")
    }),
    ("employees", "employee_id", {"employee_role": "role", "employee_active_flag": "active_flag"}),
]
POLICY_COLUMNS = """
    return_id sale_id transaction_id return_date sale_date days_until_return store_id store_name
    city province region product_id product_name product_category product_subcategory brand
    employee_id employee_role employee_active_flag customer_id return_quantity return_amount
    return_reason return_channel refund_method receipt_present item_condition late_return_flag
    no_receipt_flag damaged_or_defective_flag high_value_return_flag cleaned_policy_exception_flag
""".split()


def gold_policy_exceptions(returns: DataFrame, dimensions) -> DataFrame:
    """Returns whose source marked them as policy exceptions, with context."""
    rows = returns.filter(F.col(CLEANED_POLICY))
    for table, key, attributes in GOLD_CONTEXT:
        rows = attach(rows, dimensions[table], key, attributes)
    return rows.select(*POLICY_COLUMNS)
