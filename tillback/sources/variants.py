"""Faulty variants of the raw tables, derived from the given ones by fixed conditions on their values.

They show what the marts and the quality rules do with repeated keys, missing and unknown values,
orphans, negative amounts and returns before their sale. Conditions are plain SQL, so that the same
rows can be derived elsewhere for checking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows that are listed twice, by table.
REPEATED = {
    "sales": "quantity = 13",
    "products": "product_category = 'beauty'",
    "stores": "store_type = 'mall'",
    "customers": "loyalty_tier = 'gold'",
    "employees": "role = 'manager'",
}

# Condition and new value of spoiled columns, by table.
SPOILED = {
    "sales": {
        "sale_id": ("quantity = 17", "cast(null as string)"),
        "sale_amount": ("quantity = 19", "cast(-sale_amount as decimal(10,2))"),
        "payment_method": ("quantity = 23", "'shells'"),
        "transaction_id": ("quantity = 29", "'TXN-repeated'"),
    },
    "returns": {
        "sale_id": ("return_reason = 'defective'", "'gone-' || sale_id"),
        "return_date": ("return_reason = 'wrong_size'", "date '1990-01-01'"),
        "return_id": ("return_reason = 'other'", "cast(null as string)"),
        "return_amount": ("return_reason = 'damaged'", "cast(-return_amount as decimal(10,2))"),
    },
}


class RepeatedTables:
    """Raw tables in which the rows of ``REPEATED`` stand twice."""

    def __init__(self, raw):
        self._raw = raw

    def __getitem__(self, table: str) -> DataFrame:
        rows = self._raw[table]
        return rows.unionByName(rows.filter(REPEATED[table])) if table in REPEATED else rows


class SpoiledTables:
    """Raw tables with the values of ``SPOILED``."""

    def __init__(self, raw):
        self._raw = raw

    def __getitem__(self, table: str) -> DataFrame:
        rows, spoiled = self._raw[table], SPOILED.get(table, {})
        return rows.selectExpr(*[
            f"case when {spoiled[name][0]} then {spoiled[name][1]} else {name} end as {name}" if name in spoiled else name
            for name in rows.columns
        ])


# Keys of a table that many rows lack or share. The conditions are read in order.
HOT = {
    "returns": {
        "sale_id": [("return_quantity % 5 < 2", "cast(null as string)"), ("return_reason = 'defective'", "'gone-' || sale_id")],
        "product_id": [("return_quantity % 3 = 0", "'P1'")],
    },
}

# Rows that stand twice under one id, the second time with another store, employee and reason.
DOUBLED_RETURNS = "return_reason = 'damaged' or return_reason = 'wrong_size'"
DOUBLE = {"store_id": "'S1'", "return_reason": "case when return_reason = 'damaged' then 'damaged' else 'other' end", "employee_id": "'E1-1'"}


class HotTables:
    """Raw tables with the keys of ``HOT``."""

    def __init__(self, raw):
        self._raw = raw

    def __getitem__(self, table: str) -> DataFrame:
        rows, hot = self._raw[table], HOT.get(table, {})
        return rows.selectExpr(*[
            f"case {' '.join(f'when {condition} then {value}' for condition, value in hot[name])} else {name} end as {name}" if name in hot else name
            for name in rows.columns
        ])


class DoubledReturns:
    """Raw tables in which some returns stand twice under the same id."""

    def __init__(self, raw):
        self._raw = raw

    def __getitem__(self, table: str) -> DataFrame:
        rows = self._raw[table]
        if table != "returns":
            return rows
        again = rows.filter(DOUBLED_RETURNS).selectExpr(*[f"{DOUBLE[name]} as {name}" if name in DOUBLE else name for name in rows.columns])
        return rows.unionByName(again)
