"""The six raw retail tables derived from the generic order tables (lineitem, orders, part, ...).

Only arithmetic that every SQL engine evaluates alike is used, so the same rows can be derived
elsewhere for checking. Frames are built per call: nothing is cached between data folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillback.domains import TABLES
from tillback.sources.scratch import settled

# Load metadata given to derived rows.
LOADED_AT = "2025-01-01 00:00:00"

# Code -> label tables of the derivation; the last label takes every other code.
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "credit_card", "2-HIGH": "debit_card", "3-MEDIUM": "cash",
    "4-NOT SPECIFIED": "gift_card", None: "store_credit",
}
CHANNEL_BY_LINE = {0: "in_store", 1: "online", None: "curbside_pickup"}
REASON_BY_INDEX = {
    0: "changed_mind", 1: "wrong_size", 2: "defective", 3: "damaged", 4: "not_as_described",
    5: "duplicate_purchase", 6: "late_delivery", None: "other",
}
RETURN_CHANNEL_BY_ORDER = {0: "in_store", 1: "mail", None: "curbside"}
CONDITION_BY_ORDER = {
    0: "unopened", 1: "opened", 2: "damaged", 3: "defective", None: "missing_packaging",
}
CATEGORY_BY_TYPE = {
    "ECONOMY": "grocery", "SMALL": "beauty", "MEDIUM": "home", "PROMO": "apparel",
    "STANDARD": "sporting_goods", None: "electronics",
}
STORE_TYPE_BY_KEY = {
    0: "flagship", 1: "mall", 2: "outlet", 3: "neighbourhood", None: "warehouse",
}
TIER_BY_SEGMENT = {
    "HOUSEHOLD": "none", "MACHINERY": "bronze", "FURNITURE": "silver", "BUILDING": "gold",
    None: "platinum",
}
ROLE_BY_LINE = {
    1: "sales_associate", 2: "cashier", 3: "customer_service", 4: "returns_specialist",
    5: "stock_associate", 6: "supervisor", None: "manager",
}


def _label(code: str, labels: dict, name: str) -> str:
    """SQL text of a code -> label table; the label without a code takes all other codes."""
    known = " ".join(f"when {code} = {key!r} then '{label}'" for key, label in labels.items() if key is not None)
    return f"case {known} else '{labels[None]}' end as {name}"


def _id(prefix: str, *codes: str) -> str:
    """SQL text of an identifier: the prefix, then the codes joined by dashes."""
    return f"'{prefix}' || " + " || '-' || ".join(f"cast({code} as string)" for code in codes)


# The columns read from the given tables.
GIVEN = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_discount double, l_returnflag string, l_shipdate timestamp_ntz""",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Derivation of sale lines from lineitem, orders and part. Only the given numbers are moved
# by the joins; texts are made of them afterwards.
PRICE = "cast(cast(p_retailprice as decimal(10,2)) * 0.02BD as decimal(10,2)) as unit_price"
SHIP_DAY = "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)"
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    _id("SL", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", SHIP_DAY, "cast(l_quantity as int)")
    + " as sale_id",
    _id("TXN", "l_orderkey") + " as transaction_id", "cast(l_shipdate as date) as sale_date",
    _id("S", "l_suppkey") + " as store_id",
    _id("C", "o_custkey") + " as customer_id", _id("P", "l_partkey") + " as product_id",
    "cast(l_quantity as decimal(10,0)) as quantity",
    "unit_price", "cast(l_discount as decimal(4,2)) as disc",
    _label("o_orderpriority", PAYMENT_BY_PRIORITY, "payment_method"),
    _label("l_linenumber % 3", CHANNEL_BY_LINE, "sales_channel"),
]
DISCOUNT = "cast(unit_price * quantity * disc as decimal(10,2))"
SALE_COLUMNS = [
    "sale_id", "transaction_id", "sale_date", "store_id", "customer_id",
    _id("E", "l_suppkey", "l_linenumber") + " as employee_id",
    "product_id", "quantity", "unit_price",
    f"{DISCOUNT} as discount_amount",
    f"cast(unit_price * quantity - {DISCOUNT} as decimal(10,2)) as sale_amount",
    "payment_method", "sales_channel",
]
# the square of the order key is taken modulo 7 first, so that it cannot overflow for large keys
HANDLER = (
    "1 + ((((l_orderkey % 7) * (l_orderkey % 7) + l_partkey) % 7) * (l_orderkey % 3)) % 7"
)
SENT_BACK = "l_returnflag = 'R' and (l_partkey % 4 = 0 or (l_partkey + l_orderkey) % 3 = 0)"
UNITS_BACK = "cast(1 + l_orderkey % cast(quantity as bigint) as decimal(10,0))"
RETURN_COLUMNS = [
    "'RT' || substr(sale_id, 3) as return_id", "sale_id", "transaction_id",
    "date_add(sale_date, cast((l_orderkey * 13 + l_partkey * 7) % 45 as int)) as return_date",
    "store_id", "customer_id",
    _id("E", "l_suppkey", HANDLER) + " as employee_id",
    "product_id",
    f"{UNITS_BACK} as return_quantity",
    f"cast(unit_price * (1 - disc) * {UNITS_BACK} as decimal(10,2)) as return_amount",
    _label("(l_partkey + l_linenumber) % 8", REASON_BY_INDEX, "return_reason"),
    _label("l_orderkey % 3", RETURN_CHANNEL_BY_ORDER, "return_channel"),
    "case when l_orderkey % 7 <> 0 then payment_method else 'store_credit' end as refund_method",
    "l_orderkey % 7 <> 0 as receipt_present",
    _label("l_orderkey % 5", CONDITION_BY_ORDER, "item_condition"),
    "l_orderkey % 11 = 0 as policy_exception_flag",
]
# Derivation of the dimensions.
PRODUCT_COLUMNS = [
    _id("P", "p_partkey") + " as product_id", "p_name as product_name",
    _label("p_type", CATEGORY_BY_TYPE, "product_category"),
    _id("sub_", "p_size % 5") + " as product_subcategory", "p_brand as brand",
    PRICE,
    "cast(cast(p_retailprice as decimal(10,2)) * 0.012BD as decimal(10,2)) as cost",
    "p_partkey % 25 <> 0 as active_flag",
]
STORE_COLUMNS = [
    _id("S", "s_suppkey") + " as store_id", "s_name as store_name", "n_name as city",
    _id("P", "n_regionkey") + " as province", "r_name as region",
    _label("s_suppkey % 5", STORE_TYPE_BY_KEY, "store_type"),
    "date_add(date '2010-01-01', cast(s_suppkey % 5000 as int)) as open_date",
]
CUSTOMER_COLUMNS = [
    _id("C", "c_custkey") + " as customer_id",
    _label("c_mktsegment", TIER_BY_SEGMENT, "loyalty_tier"),
    "date_add(date '2018-01-01', cast(c_custkey % 2900 as int)) as signup_date",
    "n_name as city", _id("P", "n_regionkey") + " as province",
]
EMPLOYEE_COLUMNS = [
    _id("E", "l_suppkey", "l_linenumber") + " as employee_id", _id("S", "l_suppkey") + " as store_id",
    _label("l_linenumber", ROLE_BY_LINE, "role"),
    "date_add(date '2018-01-01', cast((l_suppkey * 7 + l_linenumber) % 2900 as int)) as hire_date",
    "(l_suppkey * 7 + l_linenumber) % 10 <> 0 as active_flag",
]


class RetailTables:
    """Lazy raw tables over one data folder: ``tables["sales"]`` and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._kept: DataFrame | None = None

    def keep_lines(self) -> None:
        """Store the joined lines, for queries that read sales or returns several times."""
        if self._kept is None:
            self._kept = settled(self._lines().drop("p_partkey", "o_orderkey"), "sale-lines")

    def __getitem__(self, table: str) -> DataFrame:
        frame = getattr(self, f"_{table}")()
        return frame.selectExpr(
            "*",
            f"cast('{LOADED_AT}' as timestamp_ntz) as loaded_at",
            f"'{table}.csv' as source_file",
        )

    def keys(self):
        return TABLES

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(GIVEN[name]).parquet(f"{self._folder}/{name}.parquet")

    def _lines(self) -> DataFrame:
        if self._kept is not None:
            return self._kept
        # lines get their price while they are narrow, and then move to their orders, which the join asks for
        # unless orders are small; a file of one row group is then not left to a single task
        return (
            self._read("lineitem")
            .join(self._read("part").selectExpr("p_partkey", PRICE), F.expr("l_partkey = p_partkey"))
            .repartition("l_orderkey")
            .join(self._read("orders"), F.expr("l_orderkey = o_orderkey"))
        )

    def _sales(self) -> DataFrame:
        return self._lines().selectExpr(*LINE_COLUMNS).selectExpr(*SALE_COLUMNS)

    def _returns(self) -> DataFrame:
        return self._lines().filter(SENT_BACK).selectExpr(*LINE_COLUMNS).selectExpr(*RETURN_COLUMNS)

    def _products(self) -> DataFrame:
        return self._read("part").selectExpr(*PRODUCT_COLUMNS)

    def _stores(self) -> DataFrame:
        regions = self._read("region")
        located = self._located("supplier", "s_nationkey")
        return located.join(regions, F.expr("n_regionkey = r_regionkey")).selectExpr(*STORE_COLUMNS)

    def _customers(self) -> DataFrame:
        return self._located("customer", "c_nationkey").selectExpr(*CUSTOMER_COLUMNS)

    def _located(self, table: str, nation: str) -> DataFrame:
        return self._read(table).join(self._read("nation"), F.expr(f"{nation} = n_nationkey"))

    def _employees(self) -> DataFrame:
        seats = self._read("lineitem").select("l_suppkey", "l_linenumber").distinct()
        return seats.selectExpr(*EMPLOYEE_COLUMNS)
