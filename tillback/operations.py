"""Queries that write: loads, whole lanes, incremental marts and their monitoring.

Each takes ``Lanes`` over a data folder, writes below the shared folder and returns what a reader finds
there afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.domains import TABLES, columns, raw_ddl
from tillback.functions.labels import padded_id, spaced_title
from tillback.operators.joins import attach_split
from tillback.operators.quality import require_rows
from tillback.plans import baselines, checks, monitoring, reports
from tillback.plans.incremental import DailyTables
from tillback.plans.pipeline import VersionedStore, build_lenient, build_strict
from tillback.sources.checked_load import RejectedLanding, load_all_or_nothing
from tillback.sources.landing import write_csv
from tillback.sources.scratch import settled, shared_folder
from tillback.sources.tables import layer_schema, passing_namespace, read_mart, write_overwrite
from tillback.sources.versions import Change, VersionedTables

# Which rows of the facts land late, and the rows of each of three loads.
LATE = {
    "sales": "month(sale_date) = 3 and day(sale_date) <= 7 and quantity % 5 = 0",
    "returns": "month(return_date) = 5 and day(return_date) <= 9 and return_reason = 'damaged'",
}
LOADS = {"sales": "quantity % 3 <= {0}", "returns": "return_quantity % 3 = {0}"}
SEEN_AT = "2025-01-02 00:00:00"
SPOILED_FILE = "return_reason = 'late_delivery'"


def _tables(lanes, label: str) -> VersionedTables:
    return VersionedTables(lanes.spark, shared_folder(lanes.spark, label))


def _incremental(lanes) -> DailyTables:
    """Two batches: most rows, then those that come late."""
    tables = DailyTables(lanes.spark, shared_folder(lanes.spark, "daily"), grain="month")
    lanes.keep_lines()
    staged = {name: lanes.staged[name] for name in ("sales", "returns")}
    for batch, late in enumerate((False, True), 1):
        parts = {name: rows.filter(F.coalesce(F.expr(LATE[name]), F.lit(False)) == late) for name, rows in staged.items()}
        tables.apply(parts["sales"], parts["returns"], batch)
    return tables


def mart_daily_incremental(lanes) -> DataFrame:
    return _incremental(lanes).daily()


def mart_exceptions_incremental(lanes) -> DataFrame:
    return _incremental(lanes).exceptions()


def rolling(entity: str) -> Callable:
    return lambda lanes: baselines.rolling_return_rate(lanes.staged["sales"], lanes.staged["returns"], entity)


def store_peer_z(lanes) -> DataFrame:
    return baselines.peer_scores(lanes.mart("mart_return_rate_by_store"), "store_id", "store_type", "total_returns", "total_sales")


def load_trend(lanes) -> DataFrame:
    """Three loads of all tables, of which the facts differ in rows; the last one is recorded twice."""
    history, tables = shared_folder(lanes.spark, "history"), _tables(lanes, "loads")
    for load_no in (1, 2, 3):
        with tables.change() as change:
            for table in TABLES:
                rows = lanes.raw[table]
                rows = rows.filter(LOADS[table].format(load_no - 1)) if table in LOADS else rows
                change.write(table, rows, measures={"newest_load": F.max("loaded_at")})
        monitoring.record_load(lanes.spark, history, load_no, change.observed)
    monitoring.record_load(lanes.spark, history, 3, change.observed)
    return monitoring.load_trend(monitoring.read_history(lanes.spark, history), SEEN_AT)


def _bronze(lanes, change: Change) -> dict[str, DataFrame]:
    return {table: change.write(f"bronze_{table}", lanes.raw[table]) for table in TABLES}


def strict_lane_tables(lanes) -> DataFrame:
    """The strict lane built as one change, and its row counts as observed while it was written."""
    tables = _tables(lanes, "strict-lane")
    lanes.keep_lines()
    with tables.change() as change:
        build_strict(VersionedStore(change), lanes.raw, "retail")
    return _read_counts(tables, change)


def lenient_lane_tables(lanes) -> DataFrame:
    tables = _tables(lanes, "lenient-lane")
    with tables.change() as change:
        build_lenient(VersionedStore(change), _bronze(lanes, change), "lake")
    return _read_counts(tables, change)


def _read_counts(tables: VersionedTables, change: Change) -> DataFrame:
    """(table_name, row_count, readable): the observed counts, and whether a reader finds the table with a row."""
    rows = [(name, count, not tables.read(name).isEmpty()) for name, count in sorted(change.counts.items())]
    return tables.spark.createDataFrame(rows, "table_name string, row_count bigint, readable boolean")


def layer_row_counts(lanes) -> DataFrame:
    """Rows of every table in the raw, bronze and silver layers next to each other, and of the gold marts.

    All counts are observed while the layers are written; no layer is read to be counted.
    """
    tables = _tables(lanes, "layers")
    with tables.change() as change:
        raw = {table: change.write(f"raw_{table}", lanes.raw[table]) for table in TABLES}
        bronze = {table: change.write(f"bronze_{table}", raw[table]) for table in TABLES}
        build_lenient(VersionedStore(change), bronze, "lake")
    counts = change.counts
    rows = [(table, counts[f"raw_{table}"], counts[f"bronze_{table}"], counts[f"silver_{table}"], None) for table in TABLES]
    rows += [(name, None, None, None, count) for name, count in sorted(counts.items()) if name.startswith("gold_")]
    schema = "table_name string, raw_rows bigint, bronze_rows bigint, silver_rows bigint, gold_rows bigint"
    return lanes.spark.createDataFrame(rows, schema).withColumn("lost_rows", F.col("raw_rows") - F.col("silver_rows"))


def stored_gold(name: str) -> Callable:
    """A gold mart of the stored lane, whose returns carry marks for distinct counts; other marts are not built for it."""
    def run(lanes) -> DataFrame:
        tables = _tables(lanes, "lenient-lane")
        lanes.keep_lines()
        with tables.change() as change:
            build_lenient(VersionedStore(change), lanes.raw, "lake", only=name)
        return tables.read(name)

    return run


def copy_into_checked(lanes) -> DataFrame:
    """Three landings: a good one, one with bad files beside good ones, and a good one again."""
    spark, target = lanes.spark, _tables(lanes, "checked")
    returns = settled(lanes.raw["returns"].select(*columns("returns")), "returns-to-land")
    text = returns.selectExpr(*[f"cast({name} as string) as {name}" for name in returns.columns])
    bad = text.filter(SPOILED_FILE).withColumn("return_amount", F.lit("a lot"))
    landings = {
        "first": [text.filter("return_reason = 'other'")],
        "spoiled": [text.filter(f"not {SPOILED_FILE}"), bad],
        "whole": [text],
    }
    rows = []
    for name, parts in landings.items():
        path = shared_folder(spark, f"landing-{name}")
        for k, part in enumerate(parts):
            write_csv(part, f"{path}/{k}")
        try:
            loaded, bad_rows, files_told = load_all_or_nothing(spark, "returns", f"{path}/*", target), 0, True
        except RejectedLanding as rejected:
            loaded, bad_rows = 0, rejected.bad_rows
            told = rejected.report.filter("bad_rows > 0")
            files_told = told.agg(F.sum("bad_rows")).first()[0] == bad_rows and told.filter("bad_rows <> rows").isEmpty()
        rows.append((name, loaded, bad_rows, files_told, target.read("returns").count()))
    schema = "landing string, rows_loaded bigint, bad_rows bigint, files_told boolean, rows_in_table bigint"
    return spark.createDataFrame(rows, schema)


def attach_hot_keys(lanes) -> DataFrame:
    """Returns with their sale's date and their product's category, over keys that are missing, unknown or hot."""
    returns = settled(lanes.raw["returns"].select("return_id", "sale_id", "product_id"), "hot-returns")
    sales = settled(lanes.raw["sales"].select("sale_id", "sale_date"), "hot-sales")
    dated = settled(attach_split(returns, sales, "sale_id", {"sale_date": "sale_date"}), "hot-dated")
    return attach_split(dated, lanes.raw["products"], "product_id", {"product_category": "product_category"})


def published_mart(lanes) -> DataFrame:
    """The store mart written to a schema of marts and read back by its checked name."""
    spark = lanes.spark
    with passing_namespace(spark, "marts", shared_folder(spark, "published")) as target:
        schema = layer_schema(None, target)
        write_overwrite(lanes.mart("mart_return_rate_by_store"), f"{schema}.mart_return_rate_by_store")
        return settled(read_mart(spark, schema, "mart_return_rate_by_store"), "published-mart")


def raw_ddl_table(lanes) -> DataFrame:
    """The raw stores appended to a table that was declared before, with its declared types."""
    spark = lanes.spark
    with passing_namespace(spark, "raw", shared_folder(spark, "declared")) as target:
        spark.sql(f"CREATE TABLE {target}.stores ({raw_ddl('stores')}) USING parquet")
        lanes.raw["stores"].write.insertInto(f"{target}.stores")
        return settled(spark.table(f"{target}.stores"), "declared-stores")


def required_inputs(lanes) -> DataFrame:
    """The report's KPIs, made only if every mart that reports read has rows."""
    marts = {
        "daily": lanes.mart("mart_daily_sales_returns_summary"), "reasons": lanes.mart("mart_return_reason_summary"),
        "stores": lanes.mart("mart_return_rate_by_store"),
    }
    require_rows(**marts)
    return reports.kpis(marts["daily"])


def report_store_filter(lanes) -> DataFrame:
    """Counts by reason and store for the stores that a reader chose: the first three by name."""
    exceptions = lanes.mart("mart_return_policy_exceptions")
    choices = [row[0] for row in reports.filter_choices(exceptions, "store_name").limit(3).collect()]
    chosen = reports.filtered_exceptions(exceptions, stores=choices)
    return chosen.groupBy("store_name", "return_reason").agg(F.count("*").alias("returns"), F.sum("return_amount").cast("decimal(20,2)").alias("return_amount"))


def filter_reasons(lanes) -> DataFrame:
    return reports.filter_choices(lanes.mart("mart_return_policy_exceptions"), "return_reason")


def report_missing_columns(lanes) -> DataFrame:
    """What the report tables lack when the store mart comes without its rates and the employee mart without its role."""
    return reports.missing_report({
        "products": lanes.mart("mart_return_rate_by_product"),
        "stores": lanes.mart("mart_return_rate_by_store").drop("policy_exception_rate", "no_receipt_return_rate"),
        "employees": lanes.mart("mart_employee_return_activity").drop("employee_role"),
    })


def forbidden_columns(lanes) -> DataFrame:
    """Customer columns that identify a person (there are none), and those of the other dimensions."""
    return checks.identifying_columns({name: lanes.raw[name].select(*columns(name)) for name in ("customers", "stores", "products", "employees")})


def exception_labels(lanes) -> DataFrame:
    """Exceptions by type under their display names."""
    counts = reports.exception_counts(lanes.mart("mart_return_policy_exceptions"))
    return counts.select(spaced_title(F.col("exception_type")).alias("exception_label"), "return_count")


def zero_padded_ids(lanes) -> DataFrame:
    """Products under the zero-padded ids that printed lists use."""
    number = F.substring("product_id", 2, 20).cast("bigint")
    return lanes.staged["products"].select("product_id", padded_id("PRD", number, 6).alias("padded_id"))


def quality_all(lanes_to_models: Callable) -> Callable:
    return lambda lanes: checks.every_rule(lanes_to_models(lanes))


GOLD_COUNTED = [
    "gold_daily_sales_returns_summary", "gold_return_rate_by_product", "gold_return_rate_by_store",
    "gold_return_reason_summary", "gold_employee_return_activity",
]

OPERATIONS = {
    "mart_daily_incremental": mart_daily_incremental,
    "mart_exceptions_incremental": mart_exceptions_incremental,
    "rolling_return_rate_store": rolling("store_id"),
    "rolling_return_rate_product": rolling("product_id"),
    "store_peer_z": store_peer_z,
    "load_trend": load_trend,
    "strict_lane_tables": strict_lane_tables,
    "lenient_lane_tables": lenient_lane_tables,
    "layer_row_counts": layer_row_counts,
    "copy_into_checked": copy_into_checked,
    "published_mart": published_mart,
    "raw_ddl_table": raw_ddl_table,
    "report_required_inputs": required_inputs,
    "report_store_filter": report_store_filter,
    "report_filter_reasons": filter_reasons,
    "report_missing_columns": report_missing_columns,
    "report_exception_labels": exception_labels,
    "zero_padded_ids": zero_padded_ids,
    "quality_forbidden_columns": forbidden_columns,
}
