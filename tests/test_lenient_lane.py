"""Hand-computed rows for the lenient lane."""

import datetime as dt

import pytest

from rows import by
from tillback.plans import analysis, gold
from tillback.plans.silver import Silver, cleaned, silver_returns, silver_sales


def test_text_and_unreadable_values(text):
    row = silver_sales(text("sales", {
        "sale_id": " SL1 ", "sale_date": "2024-02-30", "quantity": "x", "payment_method": "  ", "store_id": "S1",
    })).first()
    assert (row.sale_id, row.sale_date, row.quantity, row.payment_method, row.store_id) == ("sl1", None, None, None, "s1")
    assert row.gross_sale_amount is None and row.net_sale_amount is None and row.discount_rate is None
    assert cleaned(text("stores", {"province": "ON"}), "stores").first().province == "on"


def test_row_filters(text):
    rows = text(
        "sales", {"sale_id": None}, {"sale_id": "  "}, {"sale_id": "A", "sale_amount": "-1"},
        {"sale_id": "B", "sale_amount": None}, {"sale_id": "C", "sale_amount": "0"},
    )
    assert set(by(silver_sales(rows), "sale_id")) == {"b", "c"}


@pytest.mark.parametrize("quantity, discount, net, rate", [
    ("2", "1.00", 19.0, 0.05), ("2", None, 20.0, 0.0), ("0", "1.00", -1.0, None), ("-2", "1.00", -21.0, None),
])
def test_sale_measures(text, quantity, discount, net, rate):
    row = silver_sales(text("sales", {"quantity": quantity, "discount_amount": discount})).first()
    assert (row.net_sale_amount, row.discount_rate) == (net, rate)


@pytest.mark.parametrize("word, value", [("Yes", True), ("0", False), ("maybe", None), (None, None), (" T ", True)])
def test_booleans(text, word, value):
    row = cleaned(text("products", {"active_flag": word}), "products").first()
    assert row.active_flag is value


@pytest.mark.parametrize("changes, flags", [
    ({"return_amount": "99.99"}, (False, False, False, False)),
    ({"return_amount": "100"}, (False, False, False, True)),
    ({"return_amount": None}, (False, False, False, None)),
    ({"receipt_present": None}, (False, None, False, False)),
    ({"receipt_present": "no"}, (False, True, False, False)),
    ({"return_reason": "slightly damaged"}, (False, False, True, False)),
    ({"item_condition": None, "return_reason": None}, (False, False, False, False)),
    ({"sale_id": "none"}, (None, False, False, False)),
    ({"return_date": "2024-01-31"}, (False, False, False, False)),
    ({"return_date": "2024-02-01"}, (True, False, False, False)),
])
def test_return_flags(text, changes, flags):
    row = silver_returns(text("returns", changes), cleaned(text("sales", {}), "sales")).first()
    assert (
        row.late_return_flag, row.no_receipt_flag, row.damaged_or_defective_flag, row.high_value_return_flag
    ) == flags


def silver_of(text, sales, returns, **dimensions):
    tables = {"sales": text("sales", *sales), "returns": text("returns", *returns)}
    for table in ("products", "stores", "customers", "employees"):
        tables[table] = text(table, *dimensions.get(table, [{}]))
    return Silver(tables)


def test_store_mart_keeps_unknown_keys(text):
    silver = silver_of(
        text, [{}, {"sale_id": "SL2", "store_id": "S9"}, {"sale_id": "SL3", "store_id": None}],
        [{}, {"return_id": "R2", "store_id": "S2"}, {"return_id": "R3", "store_id": None}],
        stores=[{}, {"store_id": "S2"}, {"store_id": "S3"}],
    )
    rows = gold.gold_return_rate_by_store(silver["stores"], silver["sales"], silver["returns"]).collect()
    stores = {row.store_id: row for row in rows if row.store_id}
    assert len(rows) == 6 and sum(row.store_id is None for row in rows) == 2
    assert stores["s9"].store_name is None and stores["s9"].return_rate_by_units == 0.0
    assert stores["s2"].return_rate_by_units is None and stores["s3"].sale_count == 0
    assert stores["s1"].return_rate_by_units == 0.5


def test_daily_null_dates_stay_apart(text):
    silver = silver_of(text, [{"sale_date": None}], [{"return_date": None}])
    rows = gold.gold_daily_sales_returns_summary(silver["sales"], silver["returns"]).collect()
    assert sorted((row.activity_date, row.sale_count, row.return_count) for row in rows) == [(None, 0, 1), (None, 1, 0)]


def test_repeated_ids_count_once(text):
    silver = silver_of(text, [{}, {}], [{}])
    row = gold.gold_return_rate_by_product(silver["products"], silver["sales"], silver["returns"]).first()
    assert (row.sale_count, row.units_sold, row.return_count, row.units_returned) == (1, 4, 1, 2)


def test_unknown_reason(text):
    silver = silver_of(text, [{}], [{"return_reason": None}])
    row = gold.gold_return_reason_summary(silver["returns"]).first()
    assert row.return_reason == "unknown" and row.avg_days_until_return == 10.0


def test_only_marked_returns_are_policy_exceptions(text):
    silver = silver_of(text, [{}], [
        {"policy_exception_flag": "1"}, {"return_id": "R2", "policy_exception_flag": None}, {"return_id": "R3"},
    ])
    rows = gold.gold_policy_exceptions(silver["returns"], silver).collect()
    assert [row.return_id for row in rows] == ["r1"]
    assert rows[0].employee_role == "cashier" and rows[0].sale_date == dt.date(2024, 1, 1)


def test_overview_without_sales(text):
    silver = silver_of(text, [{"sale_id": None}], [{}])
    daily = gold.gold_daily_sales_returns_summary(silver["sales"], silver["returns"])
    row = analysis.overview(daily).first()
    assert row.total_returns == 1 and row.overall_return_rate_by_amount is None
