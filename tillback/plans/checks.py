"""The inventory of quality rules and the jobs that run them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.domains import (
    PAYMENT_METHODS, PRIMARY_KEYS, RETURN_CHANNELS, RETURN_REASONS, SALES_CHANNELS, TABLES, columns,
)
from tillback.operators import quality
from tillback.operators.rules import TableRules, check_all

# Columns without nulls, per model.
NOT_NULL = {
    "stg_sales": "sale_id sale_amount",
    "stg_returns": "return_id return_amount",
    "stg_products": "product_id",
    "stg_stores": "store_id",
    "stg_customers": "customer_id",
    "stg_employees": "employee_id",
    "int_sales_enriched": "sale_id product_id store_id customer_id employee_id net_sale_amount discount_rate",
    "int_returns_enriched": "return_id sale_id return_amount return_reason",
    "int_sales_returns_joined": "sale_id returned_flag return_count unit_return_rate",
    "mart_daily_sales_returns_summary": """calendar_date total_sales total_sales_amount total_returns
        total_return_amount return_rate net_revenue_after_returns""",
    "mart_return_rate_by_product": """product_id total_units_sold total_sales_amount total_units_returned
        total_return_amount return_rate high_return_product_flag""",
    "mart_return_rate_by_store": """store_id total_sales total_sales_amount total_returns
        total_return_amount return_rate no_receipt_return_rate policy_exception_rate""",
    "mart_return_reason_summary": """return_reason total_returns total_return_amount percent_of_returns
        average_return_amount""",
    "mart_return_policy_exceptions": "return_id sale_id exception_reason return_reason",
    "mart_employee_return_activity": """employee_id total_returns_processed total_return_amount_processed
        no_receipt_returns_processed policy_exception_returns_processed average_return_amount
        unusual_return_activity_flag""",
}
# The identifying column of each model.
UNIQUE = {
    "stg_sales": "sale_id", "stg_returns": "return_id", "stg_products": "product_id",
    "stg_stores": "store_id", "stg_customers": "customer_id", "stg_employees": "employee_id",
    "int_sales_enriched": "sale_id", "int_returns_enriched": "return_id",
    "int_sales_returns_joined": "sale_id", "mart_daily_sales_returns_summary": "calendar_date",
    "mart_return_rate_by_product": "product_id", "mart_return_rate_by_store": "store_id",
    "mart_return_reason_summary": "return_reason", "mart_return_policy_exceptions": "return_id",
    "mart_employee_return_activity": "employee_id",
}
# Columns with a closed list of values.
ACCEPTED = {
    "stg_sales": {"payment_method": PAYMENT_METHODS, "sales_channel": SALES_CHANNELS},
    "stg_returns": {"return_reason": RETURN_REASONS, "return_channel": RETURN_CHANNELS},
    "int_returns_enriched": {"return_reason": RETURN_REASONS},
    "mart_return_reason_summary": {"return_reason": RETURN_REASONS},
    "mart_return_policy_exceptions": {"return_reason": RETURN_REASONS},
}
# Column -> staged table that must know the value (under its primary key).
PARENTS = {
    "int_sales_enriched": {
        "sale_id": "sales", "product_id": "products", "store_id": "stores",
        "customer_id": "customers", "employee_id": "employees",
    },
    "int_returns_enriched": {"return_id": "returns", "sale_id": "sales"},
    "int_sales_returns_joined": {"sale_id": "sales"},
    "mart_return_rate_by_product": {"product_id": "products"},
    "mart_return_rate_by_store": {"store_id": "stores"},
    "mart_return_policy_exceptions": {"return_id": "returns", "sale_id": "sales"},
    "mart_employee_return_activity": {"employee_id": "employees"},
}
# Models that must have rows, and name parts that customer columns must not have.
NOT_EMPTY = """
    raw_sales raw_returns stg_sales stg_returns mart_daily_sales_returns_summary
    mart_return_rate_by_product mart_return_rate_by_store mart_return_policy_exceptions
""".split()
IDENTIFYING_TOKENS = ["name", "email", "phone", "address"]


def compiled_rules() -> dict[str, TableRules]:
    """All rules of the strict lane by model."""
    found: dict[str, TableRules] = {model: TableRules() for model in [*NOT_NULL, *NOT_EMPTY]}
    for model, names in NOT_NULL.items():
        found[model].not_null = names.split()
    for model, values in ACCEPTED.items():
        found[model].accepted = values
    for model, column in UNIQUE.items():
        found[model].unique = column
    for model, parents in PARENTS.items():
        found[model].parents = {column: (f"stg_{parent}", PRIMARY_KEYS[parent]) for column, parent in parents.items()}
    for model in NOT_EMPTY:
        found[model].not_empty = True
    return found


def every_rule(models) -> DataFrame:
    """Summary of all rules, each model in one scan."""
    return check_all(models, compiled_rules())


def identifying_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns whose names hold a token that customer data must not have, by table."""
    found = [(name, column) for name, frame in tables.items() for column in quality.forbidden_columns(frame, IDENTIFYING_TOKENS)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(found, "table_name string, column_name string")


def not_null(models) -> DataFrame:
    return quality.union_all([
        quality.not_null(models[model], model, names.split()) for model, names in NOT_NULL.items()
    ])


def unique(models) -> DataFrame:
    return quality.union_all([quality.unique(models[model], model, column) for model, column in UNIQUE.items()])


def accepted_values(models) -> DataFrame:
    return quality.union_all([
        quality.accepted_values(models[model], model, accepted) for model, accepted in ACCEPTED.items()
    ])


def relationships(models) -> DataFrame:
    return quality.union_all([
        quality.relationships(models[model], model, column, models[f"stg_{parent}"], PRIMARY_KEYS[parent])
        for model, parents in PARENTS.items() for column, parent in parents.items()
    ])


def not_empty(models) -> DataFrame:
    return quality.union_all([quality.not_empty(models[model], model) for model in NOT_EMPTY])


def row_counts(models, prefix: str) -> DataFrame:
    return quality.row_counts({f"{prefix}{table}": models[f"{prefix}{table}"] for table in TABLES})


def missing_primary_keys(silver) -> DataFrame:
    return quality.union_all([
        quality.row_checks(silver[table], f"silver_{table}", "missing_primary_key", {key: F.col(key).isNull()})
        for table, key in PRIMARY_KEYS.items()
    ])


def negative_amounts(tables, prefix: str) -> DataFrame:
    return quality.union_all([
        quality.row_checks(tables[table], f"{prefix}{table}", "negative_amount", {amount: F.col(amount) < 0})
        for table, amount in (("sales", "sale_amount"), ("returns", "return_amount"))
    ])


def returns_before_sale(returns: DataFrame, table: str, rule: str) -> DataFrame:
    early = F.col("return_date") < F.col("sale_date")
    return quality.row_checks(returns, table, rule, {"return_date": early})


def return_date_not_before_sale(returns: DataFrame, table: str) -> DataFrame:
    """Every return must be dated, have a sale, and not precede it."""
    valid = F.coalesce(F.col("return_date") >= F.col("sale_date"), F.lit(False))
    return quality.row_checks(returns, table, "return_date_ge_sale_date", {"return_date": ~valid})


def exact_columns(raw) -> DataFrame:
    plain = {table: raw[table].drop("loaded_at", "source_file") for table in TABLES}
    return quality.column_report(plain, {table: columns(table) for table in TABLES})
