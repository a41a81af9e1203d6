"""Report queries over the six strict marts: ordered reads, rankings, filters and KPIs.

Results stay DataFrames; only a ranking or a limited page is small by design. Orders follow the
systems the reports were written for: the warehouse puts unknown values first when descending,
rankings made after reading put them last. Every order ends with the row's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.functions.clean import as_bool
from tillback.functions.labels import (
    format_money, format_number, format_percent, label_or_id, recode,
)
from tillback.operators.ranking import top_k
from tillback.operators.shape import (
    distinct_values, explode_counts, filter_contains_any, filter_isin, normalize_columns,
    project_or_all, require_columns, split_tokens, unpivot,
)

# Ranking lengths and the page size of the exception table.
TOP_PRODUCTS = 10
TOP_EMPLOYEES = 15
PAGE_ROWS = 500

# Column sets shown by the report tables.
PRODUCT_REQUIRED = [
    "product_id", "product_name", "product_category", "total_units_sold", "total_units_returned",
    "return_rate", "total_return_amount", "top_return_reason", "high_return_product_flag",
]
STORE_SHOWN = [
    "store_id", "store_name", "store_city", "store_region", "total_sales", "total_returns",
    "return_rate", "policy_exception_rate", "no_receipt_return_rate",
]
EXCEPTION_SHOWN = [
    "return_id", "return_date", "store_name", "product_name", "customer_loyalty_tier",
    "employee_id", "return_reason", "return_amount", "days_until_return", "exception_reason",
]
EMPLOYEE_SHOWN = [
    "employee_id", "store_id", "employee_role", "total_returns_processed",
    "total_return_amount_processed", "policy_exception_returns_processed",
    "no_receipt_returns_processed", "average_return_amount",
]
RATE_NAMES = {
    "return_rate": "Return rate",
    "policy_exception_rate": "Policy exception rate",
    "no_receipt_return_rate": "No-receipt return rate",
}

# The order in which each mart is read.
MART_ORDERS = {
    "daily": [("calendar_date", "asc")],
    "product": [("return_rate", "desc"), ("total_return_amount", "desc"), ("product_id", "asc")],
    "store": [("return_rate", "desc"), ("total_return_amount", "desc"), ("store_id", "asc")],
    "reason": [("total_returns", "desc"), ("return_reason", "asc")],
    "exceptions": [("return_date", "desc"), ("return_amount", "desc"), ("return_id", "asc")],
    "employee": [
        ("unusual_return_activity_flag", "desc"), ("total_returns_processed", "desc"), ("employee_id", "asc"),
    ],
}


def mart_order(mart: str):
    """Sort columns of a mart: unknown values last when ascending, first when descending."""
    return [
        F.desc_nulls_first(name) if way == "desc" else F.asc_nulls_last(name)
        for name, way in MART_ORDERS[mart]
    ]


def shown(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns, or the whole table when one of them is missing."""
    return project_or_all(df, wanted)[0]


def missing_report(marts: dict[str, DataFrame]) -> DataFrame:
    """Columns that a report table wants and a mart lacks: what is said beside a table shown whole instead."""
    wanted = {"products": PRODUCT_REQUIRED, "stores": STORE_SHOWN, "exceptions": EXCEPTION_SHOWN, "employees": EMPLOYEE_SHOWN}
    missing = [(name, column) for name, mart in marts.items() for column in project_or_all(normalize_columns(mart), wanted[name])[1]]
    spark = next(iter(marts.values())).sparkSession
    return spark.createDataFrame(missing, "report_table string, missing_column string")


def ordered(mart: str, df: DataFrame) -> DataFrame:
    return normalize_columns(df).orderBy(*mart_order(mart))


def kpis(daily: DataFrame) -> DataFrame:
    """Totals over all days, as numbers and as display text."""
    totals = daily.agg(
        F.sum("total_sales").alias("total_sales"),
        F.sum("total_sales_amount").cast("decimal(22,2)").alias("total_sales_amount"),
        F.sum("total_returns").alias("total_returns"),
        F.sum("total_return_amount").cast("decimal(22,2)").alias("total_return_amount"),
        F.sum("net_revenue_after_returns").cast("decimal(22,2)").alias("net_revenue"),
    )
    share = F.when(F.col("total_sales") != 0, F.col("total_returns") / F.col("total_sales")).otherwise(0.0)
    return totals.withColumn("overall_return_rate", share).withColumns({
        "total_sales_text": format_number(F.col("total_sales")),
        "total_sales_amount_text": format_money(F.col("total_sales_amount")),
        "net_revenue_text": format_money(F.col("net_revenue")),
        "total_returns_text": format_number(F.col("total_returns")),
        "total_return_amount_text": format_money(F.col("total_return_amount")),
        "overall_return_rate_text": format_percent(F.col("overall_return_rate")),
    })


def daily_trends(daily: DataFrame) -> DataFrame:
    dated = daily.withColumn("calendar_date", F.col("calendar_date").cast("timestamp_ntz"))
    chart = dated.select("calendar_date", "total_sales_amount", "total_return_amount", "return_rate")
    return chart.orderBy(*mart_order("daily"))


def _labelled_products(products: DataFrame) -> DataFrame:
    checked = require_columns(normalize_columns(products), PRODUCT_REQUIRED)
    return checked.withColumns({
        "product_label": label_or_id("product_name", "product_id"),
        "high_return_product_flag": as_bool("high_return_product_flag"),
    })


def top_products_by_rate(products: DataFrame) -> DataFrame:
    order = [F.desc("return_rate"), F.desc("total_units_sold"), F.asc("product_id")]
    best = top_k(_labelled_products(products), order, TOP_PRODUCTS)
    chart = best.select("product_id", "product_label", "return_rate", "total_units_sold")
    return chart.orderBy("return_rate", "product_id")


def top_products_by_amount(products: DataFrame) -> DataFrame:
    order = [F.desc("total_return_amount"), F.asc("product_id")]
    best = top_k(_labelled_products(products), order, TOP_PRODUCTS)
    chart = best.select("product_id", "product_label", "total_return_amount")
    return chart.orderBy("total_return_amount", "product_id")


def high_return_products(products: DataFrame) -> DataFrame:
    flagged = _labelled_products(products).filter("high_return_product_flag")
    return shown(flagged.orderBy(*mart_order("product")), PRODUCT_REQUIRED[:-1])


def store_rates_long(stores: DataFrame) -> DataFrame:
    labelled = normalize_columns(stores).withColumn("store_label", label_or_id("store_name", "store_id"))
    long = unpivot(labelled, ["store_label"], list(RATE_NAMES), "metric", "rate")
    return long.withColumn("metric", recode(F.col("metric"), RATE_NAMES))


def store_table(stores: DataFrame) -> DataFrame:
    return shown(ordered("store", stores), STORE_SHOWN)


def return_reasons(reasons: DataFrame) -> DataFrame:
    return ordered("reason", reasons)


def filtered_exceptions(
    exceptions: DataFrame,
    reasons: list[str] | None = None,
    stores: list[str] | None = None,
    types: list[str] | None = None,
) -> DataFrame:
    rows = filter_isin(normalize_columns(exceptions), "return_reason", reasons)
    rows = filter_isin(rows, "store_name", stores)
    return filter_contains_any(rows, "exception_reason", types)


def first_exceptions(exceptions: DataFrame, rows: int = PAGE_ROWS, **chosen) -> DataFrame:
    """The first filtered exceptions in mart order, with all their columns."""
    return top_k(filtered_exceptions(exceptions, **chosen), mart_order("exceptions"), rows)


def exception_page(exceptions: DataFrame, rows: int = PAGE_ROWS, **chosen) -> DataFrame:
    """First page of the filtered exceptions in mart order."""
    return shown(first_exceptions(exceptions, rows, **chosen), EXCEPTION_SHOWN)


def exception_kpis(exceptions: DataFrame, **chosen) -> DataFrame:
    return filtered_exceptions(exceptions, **chosen).agg(
        F.count("*").alias("filtered_returns"),
        F.coalesce(F.sum("return_amount"), F.lit(0)).cast("decimal(22,2)").alias("filtered_return_amount"),
    )


def exception_counts(exceptions: DataFrame, **chosen) -> DataFrame:
    rows = filtered_exceptions(exceptions, **chosen)
    return explode_counts(rows, "exception_reason", "exception_type", "return_count")


def exception_types(exceptions: DataFrame) -> DataFrame:
    return split_tokens(exceptions, "exception_reason", "exception_type")


def filter_choices(exceptions: DataFrame, column: str) -> DataFrame:
    return distinct_values(exceptions, column)


def _flagged_employees(employees: DataFrame) -> DataFrame:
    flag = "unusual_return_activity_flag"
    return normalize_columns(employees).withColumn(flag, as_bool(flag))


def top_employees(employees: DataFrame) -> DataFrame:
    order = [F.desc("total_returns_processed"), F.asc("employee_id")]
    best = top_k(_flagged_employees(employees), order, TOP_EMPLOYEES)
    chart = best.select("employee_id", "total_returns_processed", "unusual_return_activity_flag")
    return chart.orderBy("total_returns_processed", "employee_id")


def employee_scatter(employees: DataFrame) -> DataFrame:
    return _flagged_employees(employees).select(
        "employee_id", "employee_role", "total_returns_processed", "policy_exception_returns_processed",
        "no_receipt_returns_processed", "average_return_amount", "unusual_return_activity_flag",
    )


def unusual_employees(employees: DataFrame) -> DataFrame:
    flagged = _flagged_employees(employees).filter("unusual_return_activity_flag")
    return shown(flagged.orderBy(*mart_order("employee")), EMPLOYEE_SHOWN)
