"""What wide facts are spared: joins that only repeat rows, and moves for lookups that have been counted."""

from pathlib import Path

from pyspark.sql import functions as F

from tillback.operators import joins
from tillback.operators.distinct import repeated_rows
from tillback.operators.joins import BROADCAST_BYTES, attach, likely_met, with_met
from tillback.operators.rules import TableRules, check_all
from tillback.plans import gold
from tillback.plans.incremental import DailyTables
from tillback.plans.intermediate import (
    RETURN_CONTEXT, Dimensions, attach_context, int_returns_enriched, int_sales_enriched, int_sales_returns_joined,
    joined_with_context, lines_beside_returns, repeat_by_context, return_flags, return_timing, sale_measures,
)
from tillback.plans.pipeline import VersionedStore, build_lenient, build_strict
from tillback.plans.staging import Staged
from tillback.registry import Lanes, Models, StrictModels
from tillback.sources.adapter import RetailTables
from tillback.sources.scratch import shared_folder
from tillback.sources.versions import VersionedTables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def tables(raw):
    return Staged({
        "sales": raw("sales", {}, {"sale_id": "SL2", "customer_id": None}, {"sale_id": "SL3", "product_id": "P9"}, {"sale_id": None}),
        "returns": raw("returns", {}, {"return_id": "R2", "sale_id": "SL2", "customer_id": None}, {"return_id": "R3", "sale_id": None}),
        "products": raw("products", {}, {"product_name": "Again"}, {"product_id": None}, {"product_id": None}),
        "stores": raw("stores", {}), "employees": raw("employees", {}, {}, {}),
        "customers": raw("customers", {}, {"customer_id": None}, {"customer_id": None}),
    })


def test_marts_do_not_join_dimensions_whose_keys_do_not_repeat(spark):
    lanes = Lanes(spark, FOLDER)
    assert all(repeated == 0 for _, repeated in lanes.dimensions.sizes.values())
    for name in ("mart_return_rate_by_product", "mart_return_reason_summary", "mart_daily_sales_returns_summary"):
        assert "c_mktsegment" not in plan(lanes.mart(name)) and "c_custkey" not in plan(lanes.mart(name))


def test_repeated_keys_repeat_rows_as_context_does(spark, raw):
    staged = tables(raw)
    known = Dimensions(staged)
    assert known.sizes == {"products": (4, 2), "stores": (1, 0), "customers": (3, 0), "employees": (3, 3)}
    narrow = repeat_by_context(staged["returns"], known)
    assert rows(narrow) == rows(attach_context(staged["returns"], staged, RETURN_CONTEXT).select(*narrow.columns))
    assert narrow.count() == 18


def test_context_after_matching_gives_the_same_lines(spark, raw):
    staged = tables(raw)
    known = Dimensions(staged)
    enriched = int_returns_enriched(staged["returns"], staged["sales"], staged)
    before = int_sales_returns_joined(int_sales_enriched(staged["sales"], staged), enriched)
    back = repeat_by_context(return_timing(return_flags(staged["returns"]), staged["sales"]), known)
    after = joined_with_context(int_sales_returns_joined(sale_measures(staged["sales"]), back), known)
    assert after.columns == before.columns and rows(after) == rows(before)


def test_counted_lookups_are_broadcast_up_to_a_bound(spark, raw):
    sales, products = raw("sales", {}), raw("products", {}).hint("merge")
    def joined(rows):
        return plan(attach(sales, products, "product_id", {"brand": "brand"}, rows=rows))
    assert "strategy=broadcast" in joined(1000)
    assert "strategy=broadcast" not in joined(None) and "strategy=broadcast" not in joined(BROADCAST_BYTES)


def test_rules_read_stored_columns_only(spark):
    models = Models(Lanes(spark, FOLDER))
    sold = models["int_sales_enriched"]
    assert "store_name" not in sold.columns and sold.sparkSession is spark
    # without repeated keys enriched sales are the stored staged ones: one stored file set, read by all
    assert plan(sold) == plan(models["stg_sales"]) and "lineitem" not in sold._jdf.queryExecution().executedPlan().toString()


def test_one_gold_mart_is_built_without_the_others(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "lane"))
    with tables.change() as change:
        build_lenient(VersionedStore(change), RetailTables(spark, FOLDER), "lake", only="gold_return_rate_by_store")
    assert tables.names() == ["gold_return_rate_by_store", "silver_returns", "silver_sales", "silver_stores"]
    assert tables.read("gold_return_rate_by_store").count() > 0


def test_only_lines_that_may_have_a_return_are_moved(spark, raw):
    sales = raw("sales", *[{"sale_id": f"SL{k}"} for k in range(40)], {"sale_id": None})
    returns = raw("returns", *[{"return_id": f"R{k}", "sale_id": f"SL{k}"} for k in range(0, 40, 10)], {"return_id": "R", "sale_id": None})
    known = ["SL0", "SL10", "SL20", "SL30"]
    met = {row.sale_id for row in likely_met(sales, "sale_id", returns).collect()}
    assert met >= set(known) and len(met) < 8
    # few words: many bits are set by other keys, and no key is lost
    assert {row.sale_id for row in with_met(sales, ["sale_id"], returns, words=1).filter("_met").collect()} >= set(known)
    sold, back = sale_measures(sales), return_timing(return_flags(returns), sales)
    beside, joined = lines_beside_returns(sold, back), int_sales_returns_joined(sold, back)
    assert beside.columns == joined.columns and rows(beside) == rows(joined)
    assert beside.filter("return_count > 0").count() == len(known)


def test_lines_are_joined_once_for_sales_and_returns(spark):
    lanes = Lanes(spark, FOLDER)
    before = {table: rows(lanes.raw[table]) for table in ("sales", "returns")}
    lanes.tables.keep_lines()
    for table, expected in before.items():
        assert "Join" not in plan(lanes.raw[table])
        assert rows(lanes.raw[table]) == expected


def test_increments_store_the_columns_that_marts_read(spark, raw, tmp_path):
    tables = DailyTables(spark, str(tmp_path / "daily"))
    tables.apply(raw("sales", {}), raw("returns", {}), 1)
    assert not {"payment_method", "product_id", "refund_method", "item_condition"} & set(tables.read("returns").columns)


def test_distinct_sales_are_counted_without_moving_ids(spark, raw):
    sales = raw("sales", *[{"sale_id": s, "store_id": k} for s, k in [
        ("a", "S1"), ("a", "S1"), ("a", "S2"), ("b", "S1"), (None, "S1"), (None, "S3"), ("c", None), ("c", None), ("d", "S2")]])
    sales = sales.withColumns({"gross_sale_amount": F.lit(1.0), "net_sale_amount": F.lit(1.0)})
    names = "sale_count units_sold net_sales_amount"
    plain = gold.metrics_by(sales, F.col("store_id"), gold.SALE_METRICS, names)
    counted = gold.Counted(sales, repeated_rows(sales, "sale_id")).metrics_by("store_id", names)
    assert counted.columns == plain.columns and rows(counted) == rows(plain)
    assert repeated_rows(sales.filter("sale_id = 'd' or sale_id is null"), "sale_id") is None
    assert "sale_id" not in gold.Counted(sales, None).metrics_by("store_id", names).schema.names


def test_one_gold_mart_stores_the_columns_it_reads(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "lane"))
    with tables.change() as change:
        build_lenient(VersionedStore(change), RetailTables(spark, FOLDER), "lake", only="gold_return_rate_by_store")
    assert tables.read("silver_sales").columns == gold.SALE_COLUMNS
    assert "transaction_id" not in tables.read("silver_returns").columns


def test_mart_by_product_reads_the_returns_that_were_matched(spark):
    models = StrictModels(Lanes(spark, FOLDER), context=False)
    models["int_sales_returns_joined"]
    assert "Join" not in plan(models["int_returns_enriched"])


def test_large_lookups_are_broadcast_in_chunks_and_facts_are_not_moved(spark, raw, monkeypatch):
    sales = raw("sales", *[{"sale_id": f"SL{k}", "product_id": f"P{k % 7}", "customer_id": f"C{k % 3}"} for k in range(40)],
                {"product_id": None, "customer_id": "C-unknown"}, {"product_id": "P-unknown", "customer_id": None})
    dimensions = Staged({
        "products": raw("products", *[{"product_id": f"P{k}", "brand": f"B{k}"} for k in (0, 1, 2, 3, 3, 5, 6)], {"product_id": None}),
        "customers": raw("customers", *[{"customer_id": f"C{k}", "loyalty_tier": t} for k, t in ((0, "gold"), (1, None))], {"customer_id": None}),
        "stores": raw("stores", {}), "employees": raw("employees", {}, {}),
    })
    expected = int_sales_enriched(sales, dimensions)
    known = Dimensions(dimensions)
    assert known.sizes["products"] == (8, 2)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 190)
    assert joins.chunk_count(8, RETURN_CONTEXT["products"]) > 4 and joins.chunk_count(3, RETURN_CONTEXT["customers"]) == 2
    shared = Path(shared_folder(spark, "x").removeprefix("file:")).parent
    before = set(shared.glob("*-by-chunk-*/_chunk=*"))
    found = int_sales_enriched(sales, known)
    assert "product_name" not in "".join(line for line in plan(found).splitlines() if "Join" in line)
    assert found.columns == expected.columns and rows(found) == rows(expected)
    # parts that have got their attributes are deleted
    assert set(shared.glob("*-by-chunk-*/_chunk=*")) == before
    monkeypatch.setattr("tillback.plans.intermediate.MAX_CHUNKS", 1)
    assert rows(int_sales_enriched(sales, known)) == rows(expected)


def test_tables_of_a_change_leave_no_shuffle_behind(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in map(str, (files.apply(k) for k in range(files.size()))) if "shuffle_" in name}

    before = shuffled()
    tables = VersionedTables(spark, str(tmp_path / "lane"))
    with tables.change() as change:
        change.write("numbers", spark.range(1000).repartition(3, "id"))
    assert change.counts == {"numbers": 1000} and not shuffled() - before


def test_lane_moves_only_sales_that_may_have_a_return(spark, raw, tmp_path):
    tables_in = {name: raw(name, {}) for name in ("products", "stores", "customers", "employees")}
    tables_in["sales"] = raw("sales", *[{"sale_id": f"SL{k}"} for k in range(40)], {"sale_id": None}, {"sale_id": "SL7"})
    tables_in["returns"] = raw("returns", {"sale_id": "SL7"}, {"return_id": "R2", "sale_id": "SL-gone"}, {"return_id": "R3", "sale_id": None})
    plans, before = [], {p.name for p in Path(shared_folder(spark, "x").removeprefix("file:")).parent.glob("returns-by-sale-*")}

    class Watched(VersionedStore):
        def keep(self, df, schema, name, *, fact=False):
            plans.append((name, plan(df)))
            return super().keep(df, schema, name, fact=fact)

    stored = VersionedTables(spark, str(tmp_path / "lane"))
    with stored.change() as change:
        build_strict(Watched(change), tables_in, "retail")
    moved = dict(plans)
    assert "_bits" in moved["int_returns_enriched"]
    assert "_bits" in moved["int_sales_returns_joined"]
    staged = Staged(tables_in)
    expected = int_sales_returns_joined(int_sales_enriched(staged["sales"], staged), int_returns_enriched(staged["returns"], staged["sales"], staged))
    assert rows(stored.read("int_sales_returns_joined")) == rows(expected)
    # the totals that the lines were joined with have gone
    shared = Path(shared_folder(spark, "x").removeprefix("file:")).parent
    assert {p.name for p in shared.glob("returns-by-sale-*")} == before


def test_a_key_that_is_unique_and_refers_to_a_parent_is_counted_once(spark):
    rules = TableRules(not_null=["id"], unique="id", parents={"id": ("p", "key"), "of": ("p", "key")})
    assert rules.looked_into() == ["id", "of"]
    rows_in = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", None), (None, "a"), ("c", "x")], "id string, of string")
    parents = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    found = {(r.rule, r.column_name): (r.rows_checked, r.violations) for r in check_all({"t": rows_in, "p": parents}, {"t": rules}).collect()}
    assert found == {("not_null", "id"): (5, 1), ("unique", "id"): (5, 1), ("relationships", "id"): (5, 1), ("relationships", "of"): (5, 2)}
