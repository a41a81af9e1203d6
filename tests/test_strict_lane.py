"""Hand-computed rows for the strict lane."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import by
from tillback.domains import TABLES, columns
from tillback.functions.measures import count_rate
from tillback.plans.pipeline import MART_PLANS, Store, build_strict
from tillback.operators.shares import release
from tillback.registry import Lanes, all_queries
from tillback.plans import marts, reports
from tillback.plans.intermediate import (
    int_returns_enriched, int_sales_enriched, int_sales_returns_joined, return_flags, return_timing, sale_measures,
)
from tillback.plans.staging import Staged, stage

FOLDER = "/root/testdata/sf0.001"


def test_staging_keeps_identifier_case(raw):
    row = stage(raw("sales", {"sale_id": " SL1 ", "payment_method": " Cash "}), "sales").first()
    assert (row.sale_id, row.payment_method) == ("SL1", "cash")
    assert stage(raw("stores", {"province": " on"}), "stores").first().province == "ON"


def test_staging_filters_nothing(raw):
    rows = stage(raw("sales", {"sale_amount": "-1.00"}, {"sale_amount": None}, {"sale_id": None}), "sales")
    assert rows.count() == 3


@pytest.mark.parametrize("quantity, discount, expected", [
    ("0", "1.00", None), ("2", None, None), ("-2", "1.00", Decimal("-0.0500")), ("3", "1.00", Decimal("0.0333")),
])
def test_discount_rate(raw, quantity, discount, expected):
    row = sale_measures(raw("sales", {"quantity": quantity, "discount_amount": discount})).first()
    assert row.discount_rate == expected
    assert row.net_sale_amount == Decimal("19.00")


def test_rate_is_rounded_at_six_digits_first(spark):
    # 0.1234496 becomes 0.123450 and then 0.1235; 0.1234494 becomes 0.123449 and then 0.1234
    frame = spark.createDataFrame([(1234496, 10000000)], "a bigint, b bigint")
    assert frame.select(count_rate(F.col("a"), F.col("b"))).first()[0] == Decimal("0.1235")
    frame = spark.createDataFrame([(1234494, 10000000)], "a bigint, b bigint")
    assert frame.select(count_rate(F.col("a"), F.col("b"))).first()[0] == Decimal("0.1234")


@pytest.mark.parametrize("day, late", [("2024-01-31", False), ("2024-02-01", True), (None, False)])
def test_late_flag(raw, day, late):
    row = return_timing(return_flags(raw("returns", {"return_date": day})), raw("sales", {})).first()
    assert row.late_return_flag is late


def test_orphan_return(raw):
    row = return_timing(return_flags(raw("returns", {"sale_id": "none"})), raw("sales", {})).first()
    assert row.days_until_return is None and row.late_return_flag is False


@pytest.mark.parametrize("amount, high", [("199.99", False), ("200.00", True), (None, False)])
def test_high_value(raw, amount, high):
    assert return_flags(raw("returns", {"return_amount": amount})).first().high_value_return_flag is high


@pytest.mark.parametrize("condition, reason, damaged", [
    ("damaged", "other", True), ("opened", "defective", True), ("opened", "slightly damaged", False),
    (None, None, False), (None, "damaged", True),
])
def test_damaged(raw, condition, reason, damaged):
    row = return_flags(raw("returns", {"item_condition": condition, "return_reason": reason})).first()
    assert row.damaged_or_defective_flag is damaged


def test_receipt_and_policy_nulls(raw):
    row = return_flags(raw("returns", {"receipt_present": None, "policy_exception_flag": None})).first()
    assert row.no_receipt_flag is False and row.policy_exception_flag is False


def tables(raw, sales, returns, **dimensions):
    found = {"sales": raw("sales", *sales), "returns": raw("returns", *returns)}
    for table in ("products", "stores", "customers", "employees"):
        found[table] = raw(table, *dimensions.get(table, [{}]))
    return Staged(found)


def enriched(raw, sales, returns, **dimensions):
    staged = tables(raw, sales, returns, **dimensions)
    return (
        int_sales_enriched(staged["sales"], staged),
        int_returns_enriched(staged["returns"], staged["sales"], staged),
    )


def test_repeated_sale_id_repeats_its_returns(raw):
    _, returns = enriched(raw, [{}, {}], [{}])
    assert returns.count() == 2


def test_repeated_dimension_key_repeats_the_fact(raw):
    sales, _ = enriched(raw, [{}], [{}], stores=[{}, {"store_name": "South"}])
    assert sales.count() == 2


def test_joined_rows(raw):
    returns_in = [{}, {"return_id": "R2", "product_id": "P2"}, {"return_id": "R3", "return_date": "2024-03-01"}]
    sales, returns = enriched(raw, [{}, {"sale_id": "SL2"}], returns_in)
    wide = int_sales_returns_joined(sales, returns)
    row = by(wide, "sale_id")["SL1"]
    assert (row.return_count, row.units_returned, row.returned_flag) == (2, 2, True)
    assert row.late_return_flag is True and row.unit_return_rate == Decimal("1.0000")
    row = by(wide, "sale_id")["SL2"]
    assert (row.return_count, row.returned_flag, row.late_return_flag) == (0, False, False)


def test_daily_without_dates_counts_nothing(raw):
    sales, returns = enriched(
        raw, [{}, {"sale_id": "SL2", "sale_date": None}], [{"return_date": None}, {"return_date": "2024-02-02"}]
    )
    days = by(marts.daily_sales_returns_summary(sales, returns), "calendar_date")
    assert set(days) == {None, dt.date(2024, 1, 1), dt.date(2024, 2, 2)}
    assert (days[None].total_sales, days[None].total_returns, days[None].net_revenue_after_returns) == (0, 0, 0)
    assert days[dt.date(2024, 2, 2)].return_rate == 0
    assert days[dt.date(2024, 2, 2)].net_revenue_after_returns == Decimal("-9.50")


@pytest.mark.parametrize("sold, flagged", [("9", False), ("10", True)])
def test_high_return_product(raw, sold, flagged):
    sales, returns = enriched(raw, [{"quantity": sold}], [{"return_quantity": "2"}])
    joined = int_sales_returns_joined(sales, returns)
    row = marts.return_rate_by_product(raw("products", {}), joined, returns).first()
    assert row.high_return_product_flag is flagged


def test_product_with_a_return_of_another_product(raw):
    sales, returns = enriched(raw, [{}], [{"product_id": "P2"}], products=[{}, {"product_id": "P2"}])
    joined = int_sales_returns_joined(sales, returns)
    products = by(marts.return_rate_by_product(raw("products", {}, {"product_id": "P2"}), joined, returns), "product_id")
    assert products["P1"].total_units_returned == 0 and products["P1"].top_return_reason is None
    assert products["P2"].total_units_returned == 0 and products["P2"].top_return_reason == "other"
    assert products["P2"].return_rate == 0


@pytest.mark.parametrize("first, second, leading", [
    (("damaged", "5.00"), ("other", "9.00"), "other"),
    (("other", "5.00"), ("damaged", "5.00"), "damaged"),
    ((None, "5.00"), ("damaged", "5.00"), "damaged"),
])
def test_top_reason_ties(raw, first, second, leading):
    rows = [
        {"return_id": f"R{i}", "return_reason": reason, "return_amount": amount}
        for i, (reason, amount) in enumerate((first, second))
    ]
    sales, returns = enriched(raw, [{}], rows)
    joined = int_sales_returns_joined(sales, returns)
    assert marts.return_rate_by_product(raw("products", {}), joined, returns).first().top_return_reason == leading


def test_store_rates(raw):
    sales, returns = enriched(
        raw, [{}, {"sale_id": "SL2", "store_id": "S9"}],
        [{"receipt_present": "false"}, {"return_id": "R2", "policy_exception_flag": "true"},
         {"return_id": "R3", "store_id": "S2"}],
    )
    stores = by(marts.return_rate_by_store(raw("stores", {}, {"store_id": "S2"}, {"store_id": "S3"}), sales, returns), "store_id")
    assert set(stores) == {"S1", "S2", "S3"}
    assert stores["S1"].return_rate == 2 and stores["S1"].no_receipt_return_rate == Decimal("0.5")
    assert stores["S2"].return_rate == 0 and stores["S2"].total_returns == 1
    assert stores["S3"].policy_exception_rate == 0


def test_reason_shares(raw):
    _, returns = enriched(raw, [{}], [
        {"return_reason": None}, {"return_id": "R2"}, {"return_id": "R3", "return_amount": "10.00"},
    ])
    reasons = by(marts.return_reason_summary(returns), "return_reason")
    assert reasons[None].percent_of_returns == Decimal("0.3333")
    assert reasons["other"].average_return_amount == Decimal("9.75")


@pytest.mark.parametrize("changes, reason", [
    ({"policy_exception_flag": "true"}, "source_policy_exception"),
    ({"return_date": "2024-03-01", "return_amount": "250.00"}, "late_return, high_value_return"),
    ({"receipt_present": "false", "item_condition": "damaged", "policy_exception_flag": "true"},
     "no_receipt, damaged_or_defective"),
    ({}, None),
])
def test_exception_reason(raw, changes, reason):
    _, returns = enriched(raw, [{}], [changes])
    rows = marts.return_policy_exceptions(returns).collect()
    assert [row.exception_reason for row in rows] == ([] if reason is None else [reason])


@pytest.mark.parametrize("count, unusual", [(4, False), (5, True)])
def test_unusual_employee(raw, count, unusual):
    employees = [{"employee_id": f"E{i}"} for i in range(1, 4)]
    _, returns = enriched(raw, [{}], [{"return_id": f"R{i}"} for i in range(count)])
    activity = by(marts.employee_return_activity(raw("employees", *employees), returns), "employee_id")
    assert activity["E1"].unusual_return_activity_flag is unusual
    assert activity["E2"].average_return_amount == 0 and activity["E2"].unusual_return_activity_flag is False


def lanes_over(spark, raw_tables):
    lanes = Lanes.__new__(Lanes)
    lanes.spark, lanes.raw, lanes.staged = spark, raw_tables, Staged(raw_tables)
    return lanes


@pytest.mark.parametrize("table", ["stores", "products", "customers", "employees", "sales"])
def test_registered_marts_repeat_facts_like_the_stored_build(spark, raw, table):
    """A key that is listed twice repeats its facts, in the registered queries as in a whole-lane build."""
    tables_in = {name: raw(name, *([{}, {}] if name == table else [{}])) for name in TABLES}
    lanes = lanes_over(spark, tables_in)
    day = by(lanes.mart("mart_daily_sales_returns_summary"), "calendar_date")
    assert day[dt.date(2024, 1, 1)].total_sales == 2
    assert day[dt.date(2024, 1, 11)].total_returns == 2
    assert day[dt.date(2024, 1, 11)].total_return_amount == Decimal("19.00")
    schema = f"repeated_{table}"
    try:
        built = build_strict(Store(spark), tables_in, schema)
        for name in MART_PLANS:
            assert sorted(map(str, lanes.mart(name).collect())) == sorted(map(str, built[name].collect())), name
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_page_is_cut_before_context(spark, raw):
    rows = [{"return_id": f"R{k}", "receipt_present": "false", "return_date": f"2024-01-{10 + k % 20}"} for k in range(30)]
    tables_in = {name: raw(name, {}) for name in TABLES} | {"returns": raw("returns", *rows), "stores": raw("stores", {}, {})}
    lanes = lanes_over(spark, tables_in)
    whole = reports.exception_page(lanes.mart("mart_return_policy_exceptions"))
    assert lanes.exception_page().collect() == whole.collect()
    chosen = {"stores": ["North"], "types": ["no_receipt"]}
    assert lanes.exception_page(**chosen).collect() == reports.exception_page(lanes.mart("mart_return_policy_exceptions"), **chosen).collect()
    assert lanes.exception_page(stores=["South"]).collect() == []


def test_reports_show_the_whole_table_when_a_column_is_missing(spark, raw):
    table = spark.createDataFrame([("S1", 1.0, 2.0)], "store_id string, return_rate double, total_return_amount double")
    assert reports.store_table(table).columns == table.columns


def test_enriched_facts_keep_the_column_order(spark):
    queries = all_queries()
    sold = queries["int_sales_enriched"](spark, FOLDER).columns
    back = queries["int_returns_enriched"](spark, FOLDER).columns
    both = queries["int_sales_returns_joined"](spark, FOLDER).columns
    assert sold[:13] == columns("sales") and sold[-5:] == ["gross_sale_amount", "net_sale_amount", "discount_rate", "loaded_at", "source_file"]
    assert back[:5] == ["return_id", "sale_id", "transaction_id", "sale_date", "return_date"] and back[16] == "policy_exception_flag"
    assert back[-7:] == ["days_until_return", "late_return_flag", "no_receipt_flag", "damaged_or_defective_flag", "high_value_return_flag", "loaded_at", "source_file"]
    assert both[6:9] == ["product_id", "units_sold", "unit_price"] and both[-1] == "policy_exception_flag"


def test_frames_kept_for_a_second_reading_are_released(spark):
    all_queries()["report_return_reasons"](spark, FOLDER).count()
    assert release() >= 1 and release() == 0
