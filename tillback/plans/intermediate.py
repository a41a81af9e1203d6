"""Strict lane, second layer: measures and flags on both facts, then dimension context.

Measures, flags and context are separate steps; the models that marts read have all of them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.domains import STRICT_HIGH_VALUE, columns
from tillback.functions.measures import (
    any_true, days_between, is_damaged, is_late, or_zero, rate, settled,
)
from tillback.operators.joins import MAX_CHUNKS, attach, attach_in_chunks, chunk_count, with_met
from tillback.operators.quality import union_all
from tillback.sources.scratch import passing_shuffles
from tillback.sources.scratch import settled as kept

# Context columns taken from each dimension (output name -> dimension column).
STORE_CONTEXT = {
    "store_name": "store_name", "store_city": "city", "store_province": "province",
    "store_region": "region", "store_type": "store_type",
}
PRODUCT_CONTEXT = {
    name: name for name in ("product_name", "product_category", "product_subcategory", "brand")
}
RETURN_CONTEXT = {
    "products": PRODUCT_CONTEXT,
    "stores": STORE_CONTEXT,
    "customers": {"customer_loyalty_tier": "loyalty_tier"},
    "employees": {"employee_role": "role"},
}
SALE_CONTEXT = {
    **RETURN_CONTEXT,
    "products": {**PRODUCT_CONTEXT, "product_cost": "cost", "product_active_flag": "active_flag"},
}
CONTEXT_KEYS = {
    "products": "product_id", "stores": "store_id",
    "customers": "customer_id", "employees": "employee_id",
}
MATCH_KEYS = ["sale_id", "transaction_id", "product_id", "store_id", "customer_id"]
RETURN_FLAGS = [
    "late_return_flag", "no_receipt_flag", "damaged_or_defective_flag",
    "high_value_return_flag", "policy_exception_flag",
]


# Column order of the enriched facts.
SALES_COLUMNS = [
    *columns("sales"), "product_name", "product_category", "product_subcategory", "brand", "product_cost", "product_active_flag",
    "store_name", "store_city", "store_province", "store_region", "store_type", "customer_loyalty_tier", "employee_role",
    "gross_sale_amount", "net_sale_amount", "discount_rate", "loaded_at", "source_file",
]
RETURNS_COLUMNS = [
    "return_id", "sale_id", "transaction_id", "sale_date", *columns("returns")[3:], "product_name", "product_category",
    "product_subcategory", "brand", "store_name", "store_city", "store_province", "store_region", "store_type",
    "customer_loyalty_tier", "employee_role", "days_until_return", "late_return_flag", "no_receipt_flag",
    "damaged_or_defective_flag", "high_value_return_flag", "loaded_at", "source_file",
]


class Dimensions:
    """Dimensions by name, and the sizes that one job over their keys finds when they are first asked for."""

    def __init__(self, tables):
        self._tables = tables

    def __getitem__(self, table: str) -> DataFrame:
        return self._tables[table]

    @cached_property
    def sizes(self) -> dict[str, tuple[int, int]]:
        """Rows of every dimension, and those whose known key stands in several rows."""
        keys = union_all([self[table].select(F.lit(table).alias("dimension"), F.col(key).alias("key")) for table, key in CONTEXT_KEYS.items()])
        several = F.when(F.col("key").isNotNull() & (F.col("n") > 1), F.col("n")).otherwise(0)
        counts = keys.groupBy("dimension", "key").agg(F.count("*").alias("n"))
        with passing_shuffles(keys.sparkSession):
            found = counts.groupBy("dimension").agg(F.sum("n"), F.sum(several)).collect()
        return {table: (0, 0) for table in CONTEXT_KEYS} | {row[0]: (row[1], row[2]) for row in found}


def attach_context(facts: DataFrame, dimensions, context: dict[str, dict[str, str]], *, stored: bool = False) -> DataFrame:
    """The attributes of each dimension, those of which the facts get wider last.

    With ``stored``, for facts that are wanted whole, those of counted dimensions that are too large to be broadcast come
    first, a chunk at a time; facts that meet such a dimension are stored on the way.
    """
    wanted = sorted(context.items(), key=lambda entry: len(entry[1]))
    sizes = {table: dimensions.sizes[table][0] for table in context} if isinstance(dimensions, Dimensions) else {}
    if stored:
        chunks = {table: chunk_count(sizes[table], attributes) for table, attributes in wanted if table in sizes}
        large = [table for table, n in chunks.items() if 1 < n <= MAX_CHUNKS]
        if large:
            facts = attach_in_chunks(facts, [(dimensions[table], CONTEXT_KEYS[table], context[table], sizes[table]) for table in large])
        wanted = [entry for entry in wanted if entry[0] not in large]
    for table, attributes in wanted:
        facts = attach(facts, dimensions[table], CONTEXT_KEYS[table], attributes, rows=sizes.get(table))
    return facts


def repeat_by_context(facts: DataFrame, dimensions: Dimensions) -> DataFrame:
    """The facts as ``attach_context`` repeats them, without any attribute: only repeated keys are joined, mostly none."""
    for table, key in CONTEXT_KEYS.items():
        rows = dimensions.sizes[table][1]
        if rows:
            counts = dimensions[table].groupBy(key).agg(F.count("*").alias("n")).filter(F.col(key).isNotNull() & (F.col("n") > 1))
            facts = attach(facts, counts.select(key, F.explode(F.expr("sequence(1L, n)"))), key, {}, rows=rows)
    return facts


def sale_measures(sales: DataFrame) -> DataFrame:
    """Gross and net amount and discount rate of each sale line."""
    gross = F.col("unit_price") * F.col("quantity")
    return sales.withColumns({
        "gross_sale_amount": gross.cast("decimal(12,2)"),
        "net_sale_amount": F.col("sale_amount").cast("decimal(12,2)"),
        "discount_rate": rate(F.col("discount_amount"), gross, numerator_scale=2),
    })


def return_flags(returns: DataFrame) -> DataFrame:
    """The flags of a return that its own row decides."""
    return returns.withColumns({
        "policy_exception_flag": settled(F.col("policy_exception_flag")),
        "no_receipt_flag": settled(~F.col("receipt_present")),
        "damaged_or_defective_flag": is_damaged(
            F.col("item_condition"), F.col("return_reason"), inside_words=False
        ),
        "high_value_return_flag": settled(
            F.col("return_amount") >= F.lit(STRICT_HIGH_VALUE).cast("decimal(10,2)")
        ),
    })


def return_timing(returns: DataFrame, sales: DataFrame) -> DataFrame:
    """Sale date, days until the return and the late flag, from the sale with the same id."""
    dated = attach(returns, sales, "sale_id", {"sale_date": "sale_date"})
    days = days_between("sale_date", "return_date")
    return dated.withColumns({"days_until_return": days, "late_return_flag": settled(is_late(days))})


def int_sales_enriched(sales: DataFrame, dimensions) -> DataFrame:
    return sale_measures(attach_context(sales, dimensions, SALE_CONTEXT, stored=True)).select(*SALES_COLUMNS)


def int_returns_enriched(returns: DataFrame, sales: DataFrame, dimensions, *, stored: bool = False) -> DataFrame:
    dated = return_timing(return_flags(returns), sales)
    return attach_context(dated, dimensions, RETURN_CONTEXT, stored=stored).select(*RETURNS_COLUMNS)


def returns_by_sale(returns: DataFrame) -> DataFrame:
    """Return totals per sale, product, store and customer, and the flags the frame carries."""
    flags = [flag for flag in RETURN_FLAGS if flag in returns.columns]
    return returns.groupBy(*MATCH_KEYS).agg(
        F.count("*").alias("return_count"),
        F.sum("return_quantity").alias("units_returned"),
        F.sum("return_amount").alias("return_amount"),
        F.min("return_date").alias("first_return_date"),
        F.max("return_date").alias("last_return_date"),
        *[any_true(F.col(flag)).alias(flag) for flag in flags],
    )


# Output columns that the sale line contributes as they are.
JOINED_SALE_COLUMNS = [
    "unit_price", "discount_amount", "gross_sale_amount", "net_sale_amount",
    "discount_rate", "payment_method", "sales_channel",
]
JOINED_CONTEXT = [
    "product_name", "product_category", "product_subcategory", "brand", "store_name", "store_city",
    "store_province", "store_region", "store_type", "customer_loyalty_tier", "employee_role",
]


def int_sales_returns_joined(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per enriched sale line with the totals of its returns; columns of a sale that the frame lacks are left out."""
    return _joined_line(sales.join(returns_by_sale(returns), on=MATCH_KEYS, how="left"))


def lines_beside_returns(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """The same rows for stored ``sales``: lines that surely have no return, mostly nearly all, are not moved."""
    totals = kept(returns_by_sale(returns), "returns-by-sale")
    told = with_met(sales, MATCH_KEYS, totals)
    met, alone = (told.filter(F.col("_met") == found).drop("_met") for found in (True, False))
    of_returns = [F.lit(None).cast(field.dataType).alias(field.name) for field in totals.schema if field.name not in MATCH_KEYS]
    matched = met.join(totals, on=MATCH_KEYS, how="left")
    return _joined_line(matched.unionByName(alone.select("*", *of_returns)))


def _joined_line(matched: DataFrame) -> DataFrame:
    count = or_zero(F.col("return_count"))
    units = or_zero(F.col("units_returned"))
    context = [name for name in JOINED_CONTEXT if name in matched.columns]
    return matched.select(
        "sale_id", "transaction_id", "sale_date", "store_id", "customer_id", "employee_id", "product_id",
        F.col("quantity").alias("units_sold"),
        *[name for name in JOINED_SALE_COLUMNS if name in matched.columns],
        *context,
        count.alias("return_count"),
        units.alias("units_returned"),
        or_zero(F.col("return_amount")).alias("return_amount"),
        "first_return_date",
        "last_return_date",
        (count > 0).alias("returned_flag"),
        count.cast("decimal(10,0)").alias("returned_sale_count"),
        F.lit(1).cast("decimal(10,0)").alias("sale_line_count"),
        rate(units, F.col("quantity")).alias("unit_return_rate"),
        *[settled(F.col(flag)).alias(flag) for flag in RETURN_FLAGS if flag in matched.columns],
    )


def joined_with_context(joined: DataFrame, dimensions) -> DataFrame:
    """Joined sale lines that were matched without context, with it: narrow rows meet their returns, and context comes last."""
    at = joined.columns.index("return_count")
    wide = attach_context(joined, dimensions, RETURN_CONTEXT, stored=True)
    return wide.select(*joined.columns[:at], *JOINED_CONTEXT, *joined.columns[at:])
