import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillback.domains import columns, kinds, raw_ddl  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "sales": dict(
        sale_id="SL1", transaction_id="T1", sale_date="2024-01-01", store_id="S1", customer_id="C1", employee_id="E1",
        product_id="P1", quantity="2", unit_price="10.00", discount_amount="1.00", sale_amount="19.00",
        payment_method="cash", sales_channel="online",
    ),
    "returns": dict(
        return_id="R1", sale_id="SL1", transaction_id="T1", return_date="2024-01-11", store_id="S1", customer_id="C1",
        employee_id="E1", product_id="P1", return_quantity="1", return_amount="9.50", return_reason="other",
        return_channel="mail", refund_method="cash", receipt_present="true", item_condition="opened",
        policy_exception_flag="false",
    ),
    "products": dict(
        product_id="P1", product_name="Lamp", product_category="home", product_subcategory="decor", brand="B",
        unit_price="10.00", cost="5.00", active_flag="true",
    ),
    "stores": dict(
        store_id="S1", store_name="North", city="X", province="ON", region="R", store_type="mall",
        open_date="2020-01-01",
    ),
    "customers": dict(customer_id="C1", loyalty_tier="gold", signup_date="2020-01-01", city="X", province="ON"),
    "employees": dict(employee_id="E1", store_id="S1", role="cashier", hire_date="2020-01-01", active_flag="true"),
}


def convert(kind, text):
    if text is None:
        return None
    if kind in ("count", "money"):
        return Decimal(text)
    if kind == "date":
        return dt.date.fromisoformat(text)
    if kind == "flag":
        return text == "true"
    return text


@pytest.fixture
def raw(spark):
    """Typed raw rows: ``raw("sales", {...}, ...)``, with defaults for what a row leaves out."""
    def make(table, *rows):
        data = [
            tuple(convert(kind, {**DEFAULTS[table], **row}[name]) for name, kind in kinds(table).items())
            + (dt.datetime(2025, 1, 1), f"{table}.csv")
            for row in rows
        ]
        return spark.createDataFrame(data, raw_ddl(table))

    return make


@pytest.fixture
def text(spark):
    """Raw rows with every column as text, for the lane that reads anything."""
    def make(table, *rows):
        data = [tuple({**DEFAULTS[table], **row}[name] for name in columns(table)) for row in rows]
        return spark.createDataFrame(data, ", ".join(f"{name} string" for name in columns(table)))

    return make
