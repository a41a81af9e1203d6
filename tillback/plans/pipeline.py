"""Building a whole lane into stored tables.

Each layer is written once and read back, so that later models scan only the columns they need and
never repeat a join. With ``buckets`` the fact tables are stored bucketed by sale id: the joins
between sales and returns and the distinct counts of sales then need no shuffle of the facts. Returns
are stored with marks at the first row of an id per day, product, store, employee and reason, so that
distinct counts of returns are sums of marks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillback.domains import DIMENSIONS
from tillback.operators.distinct import repeated_rows, with_first_marks
from tillback.operators.joins import likely_met
from tillback.plans import checks, gold, marts
from tillback.plans.intermediate import (
    Dimensions, int_returns_enriched, int_sales_enriched, int_sales_returns_joined, lines_beside_returns,
)
from tillback.plans.silver import cleaned, silver_returns, silver_sales
from tillback.plans.staging import Staged
from tillback.sources.scratch import passing_folders
from tillback.sources.tables import FORMAT, create_namespace, layer_schema, write_overwrite
from tillback.sources.versions import Change


@dataclass
class Store:
    """Where and how tables are written."""

    spark: SparkSession
    fmt: str = FORMAT
    buckets: int = 0

    def prepare(self, *schemas: str) -> None:
        create_namespace(self.spark, *dict.fromkeys(schemas))

    def keep(self, df: DataFrame, schema: str, name: str, *, fact: bool = False) -> DataFrame:
        table = f"{schema}.{name}"
        write_overwrite(df, table, fmt=self.fmt, bucket_by="sale_id" if fact else None, buckets=self.buckets)
        return self.spark.table(table)


class VersionedStore:
    """Tables of a change: none is visible before all are, and a failed build leaves the old ones."""

    def __init__(self, change: Change):
        self._change = change
        self.spark = change.spark

    def prepare(self, *schemas: str) -> None:
        """Versioned tables lie in one folder and need no schema."""

    def keep(self, df: DataFrame, schema: str, name: str, *, fact: bool = False) -> DataFrame:
        return self._change.write(name, df)


# Marts of the strict lane over any mapping of models (staged, intermediate) by name.
MART_PLANS = {
    "mart_daily_sales_returns_summary": lambda models: marts.daily_sales_returns_summary(
        models["int_sales_enriched"], models["int_returns_enriched"]
    ),
    "mart_return_rate_by_product": lambda models: marts.return_rate_by_product(
        models["stg_products"], models["int_sales_returns_joined"], models["int_returns_enriched"]
    ),
    "mart_return_rate_by_store": lambda models: marts.return_rate_by_store(
        models["stg_stores"], models["int_sales_enriched"], models["int_returns_enriched"]
    ),
    "mart_return_reason_summary": lambda models: marts.return_reason_summary(models["int_returns_enriched"]),
    "mart_return_policy_exceptions": lambda models: marts.return_policy_exceptions(models["int_returns_enriched"]),
    "mart_employee_return_activity": lambda models: marts.employee_return_activity(
        models["stg_employees"], models["int_returns_enriched"]
    ),
}


def build_strict(
    store: Store | VersionedStore, raw, target: str, intermediate: str | None = None, mart_schema: str | None = None
) -> dict[str, DataFrame]:
    """Intermediate and mart tables of the strict lane from six raw tables.

    Unless facts are bucketed, only sales that may have a return are moved to their returns.
    """
    middle, last = layer_schema(intermediate, target), layer_schema(mart_schema, target)
    store.prepare(middle, last)
    staged = Staged(raw)
    built: dict[str, DataFrame] = {f"stg_{table}": staged[table] for table in ("sales", "returns", *DIMENSIONS)}

    known = Dimensions(staged)
    with passing_folders(store.spark):
        sales = store.keep(int_sales_enriched(staged["sales"], known), middle, "int_sales_enriched", fact=True)
    bucketed = getattr(store, "buckets", 0) > 0
    dates = staged["sales"] if bucketed else likely_met(staged["sales"].select("sale_id", "sale_date"), "sale_id", staged["returns"])
    with passing_folders(store.spark):
        returns = store.keep(
            int_returns_enriched(staged["returns"], dates, known, stored=True), middle, "int_returns_enriched", fact=True
        )
    match = int_sales_returns_joined if bucketed else lines_beside_returns
    with passing_folders(store.spark):
        joined = store.keep(match(sales, returns), middle, "int_sales_returns_joined", fact=True)
    built.update(int_sales_enriched=sales, int_returns_enriched=returns, int_sales_returns_joined=joined)

    built.update({name: store.keep(plan(built), last, name) for name, plan in MART_PLANS.items()})
    return built


def check_strict(built: dict[str, DataFrame], raw) -> DataFrame:
    """Summary of every quality rule over the built tables."""
    models = {**built, "raw_sales": raw["sales"], "raw_returns": raw["returns"]}
    rules = (checks.not_null, checks.unique, checks.accepted_values, checks.relationships, checks.not_empty)
    return checks.quality.union_all([rule(models) for rule in rules])


# The dimensions that gold marts read, by mart.
GOLD_DIMENSIONS = {
    "gold_daily_sales_returns_summary": [],
    "gold_return_rate_by_product": ["products"],
    "gold_return_rate_by_store": ["stores"],
    "gold_return_reason_summary": [],
    "gold_policy_exceptions": ["products", "stores", "employees"],
    "gold_employee_return_activity": ["employees"],
}


def build_lenient(store: Store | VersionedStore, bronze, schema: str, only: str | None = None) -> dict[str, DataFrame]:
    """Silver and gold tables of the lenient lane from six bronze tables; ``only`` one gold mart and the tables it reads."""
    store.prepare(schema)
    wanted = DIMENSIONS if only is None else GOLD_DIMENSIONS[only]
    narrow = only not in (None, "gold_policy_exceptions")
    sold = silver_sales(bronze["sales"])
    sales = store.keep(sold.select(*gold.SALE_COLUMNS) if narrow else sold, schema, "silver_sales", fact=True)
    bucketed = getattr(store, "buckets", 0) > 0
    # bucketed sales lie by their id: neither the join with returns nor distinct counts move them
    dates = sales if bucketed else likely_met(sales.select("sale_id", "sale_date"), "sale_id", cleaned(bronze["returns"], "returns"))
    dated = silver_returns(bronze["returns"], dates)
    marked = with_first_marks(dated.select(*gold.RETURN_COLUMNS) if narrow else dated, "return_id", gold.COUNTED_BY)
    returns = store.keep(marked, schema, "silver_returns", fact=True)
    dimensions = {
        table: store.keep(cleaned(bronze[table], table), schema, f"silver_{table}") for table in wanted
    }
    if not bucketed and only != "gold_return_reason_summary":
        sales = gold.Counted(sales, repeated_rows(sales, "sale_id"))
    plans = {
        "gold_daily_sales_returns_summary": lambda: gold.gold_daily_sales_returns_summary(sales, returns),
        "gold_return_rate_by_product": lambda: gold.gold_return_rate_by_product(dimensions["products"], sales, returns),
        "gold_return_rate_by_store": lambda: gold.gold_return_rate_by_store(dimensions["stores"], sales, returns),
        "gold_return_reason_summary": lambda: gold.gold_return_reason_summary(returns),
        "gold_policy_exceptions": lambda: gold.gold_policy_exceptions(returns, dimensions),
        "gold_employee_return_activity": lambda: gold.gold_employee_return_activity(dimensions["employees"], sales, returns),
    }
    built = {"silver_sales": sales.facts if isinstance(sales, gold.Counted) else sales, "silver_returns": returns}
    built.update({f"silver_{table}": frame for table, frame in dimensions.items()})
    built.update({name: store.keep(plan(), schema, name) for name, plan in plans.items() if only in (None, name)})
    return built
