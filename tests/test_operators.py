import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillback.functions.clean import as_bool
from tillback.functions.labels import format_money, format_percent, padded_id, recode, spaced_title
from tillback.operators import shape
from tillback.operators.joins import full_merge, totals_by_key
from tillback.operators.ranking import exact_quantile, number_members, top_k
from tillback.operators.shares import share_within
from tillback.plans import reports


@pytest.mark.parametrize("q", ["0.5", "0.90", "0.92", "1", "0"])
def test_exact_quantile_matches_brute_force(spark, q):
    rng = random.Random(7)
    values = [round(rng.lognormvariate(4, 2), 2) for _ in range(700)] + [20.0] * 350 + [-3.25, None]
    frame = spark.createDataFrame([(None if v is None else Decimal(str(v)),) for v in values], "x decimal(10,2)")
    known = [v for v in values if v is not None]
    found = exact_quantile(frame, "x", q).first().value
    assert float(found) == pytest.approx(np.quantile(known, float(q)), abs=1e-6)


def test_numbers_are_dense_when_one_group_holds_most_rows(spark):
    rows = [("hot", i) for i in range(900)] + [("cold", i) for i in range(5)] + [(None, 1)]
    frame = spark.createDataFrame(rows, "g string, m int")
    numbered = number_members(frame, "m", "g", buckets=16).collect()
    for group, size in (("hot", 900), ("cold", 5), (None, 1)):
        found = [row for row in numbered if row.g == group]
        assert sorted(row.member_no for row in found) == list(range(size))
        assert {row.member_count for row in found} == {size}
    whole = number_members(frame, "m", buckets=4).collect()
    assert sorted(row.member_no for row in whole) == list(range(906))


def test_share_within(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 3), (None, 2)], "g string, w int")
    assert sorted((row.w, row.s) for row in share_within(frame, "g", "w", "s").collect()) == [(1, 0.25), (2, 1.0), (3, 0.75)]


def test_totals_and_full_merge(spark):
    left = spark.createDataFrame([(1, 10), (None, 5)], "k int, a int")
    right = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "k int, b int")
    totals = totals_by_key("k", (left, "k", {"a": F.col("a")}), (right, "k", {"b": F.col("b")}))
    assert {tuple(row) for row in totals.collect()} == {(1, 10, 1), (2, None, 2), (None, 5, 3)}
    merged = full_merge("k", left, right, zeros=["a", "b"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([(1, 10, 1), (2, 0, 2), (None, 5, 0), (None, 0, 3)], key=str)


def test_shape(spark):
    frame = spark.createDataFrame([("a, b",), ("a",), ("a",), (None,), ("b, , a ",)], "x string")
    counts = [tuple(row) for row in shape.explode_counts(frame.limit(4), "x", "item", "n").collect()]
    assert counts == [("a", 3), ("b", 1)]
    assert [row.item for row in shape.split_tokens(frame, "x", "item").collect()] == ["a", "b"]
    assert shape.normalize_columns(spark.createDataFrame([(1,)], ['" Total "'])).columns == [" total "]
    assert shape.normalize_columns(spark.createDataFrame([(1,)], [' "Total" '])).columns == ["total"]
    with pytest.raises(ValueError, match="missing columns"):
        shape.require_columns(frame, ["x", "y"])
    picked, missing = shape.project_or_all(frame, ["x", "y"], 2)
    assert missing == ["y"] and picked.columns == ["x"] and picked.count() == 2
    assert shape.filter_isin(frame, "x", []).count() == 5 and shape.filter_isin(frame, "x", ["a"]).count() == 2
    assert shape.filter_contains_any(frame, "x", ["b,", "zz"]).count() == 1
    assert [row.x for row in shape.distinct_values(frame, "x").collect()] == ["a", "a, b", "b, , a "]


def test_labels(spark):
    frame = spark.createDataFrame([("return_rate", 226402.5, 0.1234, 7, "smart_home st. x")], "m string, a double, r double, n int, t string")
    row = frame.select(
        recode(F.col("m"), {"return_rate": "Return rate"}), recode(F.lit("other"), {"x": "y"}), format_money(F.col("a")),
        format_percent(F.col("r")), padded_id("P", F.col("n"), 6), spaced_title(F.col("t")),
    ).first()
    assert tuple(row) == ("Return rate", "other", "$226,402", "12.3%", "P000007", "Smart Home St. X")


def test_as_bool(spark):
    frame = spark.createDataFrame([("True",), (" yes ",), ("on",), (None,), ("1",)], "f string")
    assert [row[0] for row in frame.select(as_bool("f")).collect()] == [True, True, False, False, True]
    flags = spark.createDataFrame([(True,), (None,)], "f boolean")
    assert [row[0] for row in flags.select(as_bool("f")).collect()] == [True, False]


def test_kpis_without_sales(spark):
    daily = spark.createDataFrame(
        [(0, Decimal(0), 2, Decimal("3.00"), Decimal("-3.00"))],
        "total_sales bigint, total_sales_amount decimal(22,2), total_returns bigint, "
        "total_return_amount decimal(22,2), net_revenue_after_returns decimal(22,2)",
    )
    row = reports.kpis(daily).first()
    assert row.overall_return_rate == 0.0 and row.net_revenue_text == "$-3" and row.overall_return_rate_text == "0.0%"


def test_exception_filters(spark):
    rows = [("r1", "damaged", "North", "late_return"), ("r2", "other", "South", "no_receipt"), ("r3", None, None, None)]
    frame = spark.createDataFrame(rows, "return_id string, return_reason string, store_name string, exception_reason string")
    ids = lambda **chosen: [row.return_id for row in reports.filtered_exceptions(frame, **chosen).collect()]
    assert ids() == ["r1", "r2", "r3"]
    assert ids(stores=["South"]) == ["r2"] and ids(reasons=["damaged"], stores=["South"]) == []
    assert ids(types=["late", "receipt"]) == ["r1", "r2"]


def test_top_k_is_not_a_single_task_sort(spark):
    plan = top_k(spark.range(1000), [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
