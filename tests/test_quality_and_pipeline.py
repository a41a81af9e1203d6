import pytest

from rows import by
from tillback.domains import TABLES, columns
from tillback.operators import quality
from tillback.plans import checks
from tillback.plans.pipeline import Store, build_lenient, build_strict, check_strict
from tillback.sources.adapter import RetailTables

FOLDER = "/root/testdata/sf0.001"


def test_violations_are_found(spark, raw):
    sales = raw(
        "sales", {}, {}, {"sale_id": None}, {"sale_id": None}, {"sale_id": "SL2", "payment_method": "shells"},
        {"sale_id": "SL3", "payment_method": None, "sale_amount": "-1.00"},
    )
    returns = raw("returns", {}, {"sale_id": "gone"}, {"sale_id": "gone"}, {"sale_id": None})
    assert quality.null_rows(sales, "sale_id").count() == 2
    assert [tuple(row) for row in quality.repeated_values(sales, "sale_id").collect()] == [("SL1", 2)]
    assert quality.unaccepted_rows(sales, "payment_method", ["cash"]).count() == 1
    assert [tuple(row) for row in quality.orphan_keys(returns, "sale_id", sales, "sale_id").collect()] == [("gone", 2)]
    assert quality.negative_rows(sales, "sale_amount").count() == 1

    summary = quality.union_all([
        quality.not_null(sales, "sales", ["sale_id", "sale_amount"]),
        quality.unique(sales, "sales", "sale_id"),
        quality.accepted_values(sales, "sales", {"payment_method": ["cash"]}),
        quality.relationships(returns, "returns", "sale_id", sales, "sale_id"),
        quality.not_empty(sales.filter("false"), "sales"),
    ])
    found = {(row.rule, row.column_name): (row.rows_checked, row.violations) for row in summary.collect()}
    assert found == {
        ("not_null", "sale_id"): (6, 2), ("not_null", "sale_amount"): (6, 0), ("unique", "sale_id"): (6, 1),
        ("accepted_values", "payment_method"): (6, 1), ("relationships", "sale_id"): (4, 2), ("not_empty", "*"): (0, 1),
    }
    assert quality.failed(summary).count() == 5


def test_return_dates(spark):
    rows = spark.sql("""
        select * from values (date '2024-01-02', date '2024-01-01'), (date '2024-01-01', date '2024-01-02'),
            (null, date '2024-01-01'), (date '2024-01-01', null) as t(return_date, sale_date)""")
    assert checks.returns_before_sale(rows, "t", "early").first().violations == 1
    assert checks.return_date_not_before_sale(rows, "t").first().violations == 3
    assert quality.before_rows(rows, "sale_date", "return_date").count() == 1


def test_columns_and_inputs(spark, raw):
    tables = {table: raw(table, {}) for table in TABLES}
    assert all(row.columns_match and row.row_count == 1 for row in checks.exact_columns(tables).collect())
    tables["stores"] = tables["stores"].withColumnRenamed("city", "town")
    assert by(checks.exact_columns(tables), "table_name")["stores"].columns_match is False
    customers = raw("customers", {}).select(*columns("customers"))
    assert quality.forbidden_columns(customers, checks.IDENTIFYING_TOKENS) == []
    assert quality.forbidden_columns(raw("products", {}), checks.IDENTIFYING_TOKENS) == ["product_name"]
    quality.require_rows(customers=customers)
    with pytest.raises(ValueError, match="stores"):
        quality.require_rows(customers=customers, stores=tables["stores"].filter("false"))


def test_strict_lane_as_tables(spark):
    import __spark_entry__ as entry

    raw = RetailTables(spark, FOLDER)
    built = build_strict(Store(spark, buckets=4), raw, "retail", intermediate="middle", mart_schema="marts")
    queries = entry.queries()
    for name in [n for n in built if n.startswith("mart_")]:
        direct = queries[name](spark, FOLDER)
        stored = spark.table(f"marts.{name}").select(*direct.columns)
        assert sorted(stored.collect(), key=str) == sorted(direct.collect(), key=str), name
    summary = check_strict(built, raw)
    assert quality.failed(summary).count() == 0 and summary.count() == 61 + 15 + 7 + 13 + 8


def test_lenient_lane_as_tables_moves_no_facts_twice(spark):
    import __spark_entry__ as entry

    built = build_lenient(Store(spark, buckets=4), RetailTables(spark, FOLDER), "lake")
    queries = entry.queries()
    for name in [n for n in built if n.startswith("gold_")]:
        direct = queries[name](spark, FOLDER)
        assert sorted(built[name].select(*direct.columns).collect(), key=str) == sorted(direct.collect(), key=str), name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = built["silver_returns"].join(built["silver_sales"].select("sale_id", "quantity"), "sale_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
