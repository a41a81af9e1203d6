"""Incremental marts, baselines, load history, compiled rules, split joins and marked distinct counts."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rows import by
from tillback.operators.distinct import FIRST_MARKS, marked_count, with_first_marks
from tillback.operators.joins import attach, attach_split
from tillback.operators.rules import TableRules, check_all, compiled
from tillback.plans import baselines, gold, monitoring
from tillback.plans.incremental import DailyTables
from tillback.plans.intermediate import return_flags, return_timing, sale_measures
from tillback.plans.marts import daily_sales_returns_summary
from tillback.plans.pipeline import Store, VersionedStore, build_lenient
from tillback.sources.adapter import RetailTables
from tillback.sources.variants import DoubledReturns
from tillback.sources.versions import VersionedTables

FOLDER = "/root/testdata/sf0.001"


def day(text):
    return dt.date.fromisoformat(text)


def files_of(folder):
    return {str(path.relative_to(folder)): path.stat().st_mtime_ns for path in folder.rglob("*.parquet")}


def test_only_affected_days_are_rewritten(spark, raw, tmp_path):
    tables = DailyTables(spark, str(tmp_path / "daily"))
    days = ["2024-01-01", "2024-01-02", "2024-01-03", None]
    sales = raw("sales", *[{"sale_id": f"SL{k}", "sale_date": d} for k, d in enumerate(days)])
    returns = raw("returns", {"return_id": "R1", "sale_id": "late", "return_date": "2024-03-01", "return_amount": "500.00"})
    assert tables.apply(sales, returns, 1) == [None, day("2024-01-01"), day("2024-01-02"), day("2024-01-03"), day("2024-03-01")]
    assert tables.exceptions().first().days_until_return is None
    before = files_of(tmp_path / "daily" / "daily")
    late = raw("sales", {"sale_id": "late", "sale_date": "2024-01-02"})
    none = raw("returns", {}).filter("false")
    # the late sale lies on one day, and gives a return of another day its date
    assert tables.apply(late, none, 2) == [day("2024-01-02"), day("2024-03-01")]
    after = files_of(tmp_path / "daily" / "daily")
    kept = [name for name in before if "2024-01-02" not in name]
    assert kept and all(after[name] == before[name] for name in kept)
    assert {row.calendar_date: row.built_by for row in tables.daily().collect()} == {
        None: 1, day("2024-01-01"): 1, day("2024-01-02"): 2, day("2024-01-03"): 1, day("2024-03-01"): 1,
    }
    exception = tables.exceptions().first()
    assert (exception.days_until_return, exception.exception_reason) == (59, "late_return, high_value_return")


@pytest.mark.parametrize("grain", ["day", "month"])
def test_batches_equal_a_full_rebuild_and_can_be_repeated(spark, raw, tmp_path, grain):
    tables = DailyTables(spark, str(tmp_path / "daily"), grain)
    sales = [{"sale_id": f"SL{k}", "sale_date": f"2024-01-{1 + k % 9:02}"} for k in range(40)]
    returns = [{"return_id": f"R{k}", "sale_id": f"SL{k}", "return_date": f"2024-02-{1 + k % 13:02}"} for k in range(30)]
    parts = [(sales[:20], returns[15:]), (sales[20:], returns[:15])]
    for batch, (some, back) in enumerate([*parts, parts[1]], 1):
        tables.apply(raw("sales", *some), raw("returns", *back), min(batch, 2))  # the last batch comes twice
    every = sale_measures(raw("sales", *sales))
    dated = return_timing(return_flags(raw("returns", *returns)), raw("sales", *sales))
    whole = daily_sales_returns_summary(every, dated)
    assert sorted(map(str, tables.daily().select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    late = {row.return_id: row.days_until_return for row in dated.filter("late_return_flag").collect()}
    assert {row.return_id: row.days_until_return for row in tables.exceptions().collect()} == late


def test_a_day_can_lose_its_last_exception(spark, raw, tmp_path):
    tables = DailyTables(spark, str(tmp_path / "daily"))
    sale = [{"sale_id": "SL1", "sale_date": "2024-01-01"}]
    tables.apply(raw("sales", *sale), raw("returns", {"sale_id": "SL1", "return_date": "2024-05-01"}), 1)
    assert tables.exceptions().count() == 1
    tables.apply(raw("sales", *sale), raw("returns", {"sale_id": "gone", "return_date": "2024-05-01"}), 1)
    assert tables.exceptions().count() == 0


def plain_rolling(sales, returns, days):
    counts = defaultdict(lambda: [0, 0])
    for at, rows in enumerate((sales, returns)):
        for entity, on in rows:
            if entity and on:
                counts[entity, on][at] += 1
    result = {}
    for (entity, on), (sold, back) in counts.items():
        past = [v for (e, d), v in counts.items() if e == entity and 1 <= (on - d).days <= days]
        base_sold, base_back = sum(v[0] for v in past), sum(v[1] for v in past)
        result[entity, on] = (sold, back, base_sold, base_back, len(past), sold > 0 and base_sold > 0 and back * base_sold > base_back * sold)
    return result


def test_rolling_rates_look_back_on_days_not_rows(spark, raw):
    start = day("2024-01-01")
    sales = [(f"S{k % 3}" if k % 7 else None, start + dt.timedelta(days=(k * k) % 95)) for k in range(120)]
    returns = [(f"S{k % 4}", start + dt.timedelta(days=(k * 5) % 97)) for k in range(60)] + [("S1", None)]
    rows = baselines.rolling_return_rate(
        raw("sales", *[{"store_id": s, "sale_date": str(d)} for s, d in sales]),
        raw("returns", *[{"store_id": s, "return_date": d and str(d)} for s, d in returns]), "store_id", 30,
    ).collect()
    found = {(r.entity_id, r.activity_date): (r.sales, r.returns, r.baseline_sales, r.baseline_returns, r.baseline_days, r.above_baseline) for r in rows}
    assert found == plain_rolling(sales, returns, 30)


def test_peer_scores(spark):
    rows = [("a", "x", 1, 10), ("b", "x", 2, 10), ("c", "x", 9, 10), ("d", "alone", 1, 2), ("e", "same", 1, 4), ("f", "same", 2, 8),
            ("g", "x", 5, 0), ("h", None, 1, 2), ("i", None, 1, 4)]
    found = by(baselines.peer_scores(spark.createDataFrame(rows, "id string, kind string, part bigint, whole bigint"), "id", "kind", "part", "whole"), "id")
    assert [float(found[k].z_score) for k in "abc"] == [-0.6882, -0.4588, 1.1471]
    assert found["a"].peers == 3 and found["g"].z_score is None and found["g"].peers == 3
    assert found["d"].z_score is None and found["e"].z_score is None and float(found["h"].z_score) == 0.7071
    crowd = [(f"n{k}", "x", 1, 100) for k in range(30)] + [("odd", "x", 50, 100)]
    found = by(baselines.peer_scores(spark.createDataFrame(crowd, "id string, kind string, part bigint, whole bigint"), "id", "kind", "part", "whole"), "id")
    assert found["odd"].above_peers and not found["n1"].above_peers


def test_history_of_loads(spark, tmp_path):
    history, loaded = str(tmp_path / "history"), dt.datetime(2025, 1, 1)
    for load, rows in enumerate([10, 10, 40, 0], 1):
        monitoring.record_load(spark, history, load, {"a": {"row_count": rows, "newest_load": loaded if rows else None}})
    monitoring.record_load(spark, history, 4, {"a": {"row_count": 20, "newest_load": loaded}, "b": {"row_count": 1, "newest_load": None}})
    found = {(r.table_name, r.load_no): r for r in monitoring.load_trend(monitoring.read_history(spark, history), "2025-01-03 00:00:00", 2).collect()}
    assert len(found) == 5 and found["a", 1].trailing_mean is None and found["a", 1].change is None
    assert (float(found["a", 3].trailing_mean), float(found["a", 3].change), found["a", 3].unusual_count) == (10.0, 3.0, True)
    assert (float(found["a", 4].trailing_mean), float(found["a", 4].change), found["a", 4].rows_since) == (25.0, -0.2, -20)
    assert (found["a", 4].age_hours, found["a", 4].stale, found["b", 4].stale) == (48, True, True)


def rules_of(spark):
    rows = [("1", "x", "p"), ("1", "y", "p"), (None, None, "gone"), (None, "x", None), ("2", "z", "q")]
    df = spark.createDataFrame(rows, "id string, kind string, parent string")
    rules = TableRules(
        not_null=["id", "kind"], accepted={"kind": ["x", "y"]}, violated={("no_z", "kind"): F.col("kind") == "z"}, unique="id",
        parents={"parent": ("parents", "key"), "id": ("parents", "key")}, not_empty=True,
    )
    parents = spark.createDataFrame([("p",), ("p",), ("q",), ("1",), (None,)], "key string")
    return df, rules, parents


def test_compiled_rules(spark):
    df, rules, parents = rules_of(spark)
    found = {(r.rule, r.column_name): (r.rows_checked, r.violations) for r in compiled(df, "t", rules, {"parents": parents}).collect()}
    assert found == {
        ("not_null", "id"): (5, 2), ("not_null", "kind"): (5, 1), ("accepted_values", "kind"): (5, 1), ("no_z", "kind"): (5, 1),
        ("unique", "id"): (5, 1), ("relationships", "parent"): (5, 1), ("relationships", "id"): (5, 1), ("not_empty", "*"): (5, 0),
    }
    empty = {(r.rule, r.column_name): (r.rows_checked, r.violations) for r in compiled(df.filter("false"), "t", rules, {"parents": parents}).collect()}
    assert empty == {key: (0, int(key[0] == "not_empty")) for key in found}


def test_rules_of_a_table_need_one_scan(spark, tmp_path):
    df, rules, parents = rules_of(spark)
    for name, rows in (("t", df.withColumn("unused", F.lit(1))), ("parents", parents)):
        rows.write.parquet(str(tmp_path / name))
    models = {name: spark.read.parquet(str(tmp_path / name)) for name in ("t", "parents")}
    summary = check_all(models, {"t": rules})
    executed = summary._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in executed.splitlines() if "FileScan" in line]
    assert sum("kind" in line for line in scans) == 1 and not any("unused" in line for line in scans), executed


def test_presence_looks_at_one_row(spark):
    rows = spark.range(1000).withColumnRenamed("id", "x")
    summary = check_all({"t": rows}, {"t": TableRules(not_empty=True)})
    assert [tuple(r) for r in summary.collect()] == [("not_empty", "t", "*", 1, 0)]
    assert [tuple(r) for r in check_all({"t": rows.filter("false")}, {"t": TableRules(not_empty=True)}).collect()] == [("not_empty", "t", "*", 0, 1)]


def hot_facts(spark):
    keys = [None] * 400 + ["hot"] * 300 + [f"k{k}" for k in range(200)] + [f"gone{k}" for k in range(100)]
    facts = spark.createDataFrame([(k, key) for k, key in enumerate(keys)], "id int, key string").repartition(8)
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), *[(f"k{k}", k) for k in range(200)], (None, 9)], "key string, value int")
    return facts, lookup


@pytest.mark.parametrize("share", [2, 100])
def test_split_joins_give_the_rows_of_a_join(spark, share):
    facts, lookup = hot_facts(spark)
    split = attach_split(facts, lookup, "key", {"found": "value"}, heavy_share=share, salts=7)
    plain = attach(facts, lookup, "key", {"found": "value"})
    assert split.columns == plain.columns and sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    empty = attach_split(facts.filter("false"), lookup, "key", {"found": "value"})
    assert empty.count() == 0


def test_split_joins_spread_a_hot_key(spark):
    facts, lookup = hot_facts(spark)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        split = attach_split(facts, lookup, "key", {"found": "value"}, salts=16)
        hot = split.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) >= 8 and max(row["count"] for row in hot) <= sum(row["count"] for row in hot) / 3
        unmatched = split.filter("key is null")._jdf.queryExecution().executedPlan().toString()
        assert "isnull(key" in unmatched
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_marks_add_up_to_distinct_counts(spark):
    rows = [(f"R{k % 9}" if k % 5 else None, f"S{k % 4}", "a" if k % 3 else None) for k in range(70)] + [("once", "S1", "a")]
    df = spark.createDataFrame(rows, "id string, store string, reason string")
    keys = {"store": "store", "reason": "coalesce(reason, 'unknown')"}
    marked = with_first_marks(df, "id", keys)
    assert marked.columns == [*df.columns, FIRST_MARKS] and marked.count() == len(rows)
    for k, text in enumerate(keys.values()):
        counts = marked.groupBy(F.expr(text).alias("g")).agg(marked_count(k).alias("marks"), F.countDistinct("id").alias("ids")).collect()
        assert counts and all(row["marks"] == row["ids"] for row in counts)


def test_gold_marts_move_partial_sums_of_returns(spark):
    built = build_lenient(Store(spark, buckets=4), DoubledReturns(RetailTables(spark, FOLDER)), "marked_lake")
    returns = built["silver_returns"]
    for number, key in enumerate(gold.COUNTED_BY):
        mart = gold.metrics_by(returns, F.col(key), gold.RETURN_METRICS, "return_count units_returned", key)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "return_id" not in plan and plan.count("Exchange") == 1, plan
        plain = returns.groupBy(key).agg(F.countDistinct("return_id").alias("n"))
        assert {r[0]: r[1] for r in mart.select(key, "return_count").collect()} == {r[0]: r[1] for r in plain.collect()}, number


def test_a_lane_that_fails_midway_leaves_the_old_tables(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "lake"))
    raw = RetailTables(spark, FOLDER)
    with tables.change() as change:
        build_lenient(VersionedStore(change), raw, "lake")
    names, rows = tables.names(), tables.read("gold_return_rate_by_store").count()

    class Broken:
        def __getitem__(self, table):
            return raw[table].withColumn("store_id", F.raise_error(F.lit("disk lost"))) if table == "employees" else raw[table]

    with pytest.raises(Exception, match="disk lost"):
        with tables.change() as change:
            build_lenient(VersionedStore(change), Broken(), "lake")
    assert tables.names() == names and tables.versions() == [1] and tables.read("gold_return_rate_by_store").count() == rows
