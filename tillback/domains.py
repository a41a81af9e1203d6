"""Data model: tables, column kinds, keys and value domains.

Everything here is fixed by the data contract, so it is kept as plain text in one place.
"""

from __future__ import annotations

# Ordered columns of the six input tables, each with its kind.
#   text   identifier or free text      label  lower-case category     code  upper-case code
#   count  whole number                 money  two decimals            flag  boolean           date
COLUMN_KINDS = {
    "sales": """
        sale_id:text transaction_id:text sale_date:date store_id:text customer_id:text
        employee_id:text product_id:text quantity:count unit_price:money discount_amount:money
        sale_amount:money payment_method:label sales_channel:label
    """,
    "returns": """
        return_id:text sale_id:text transaction_id:text return_date:date store_id:text
        customer_id:text employee_id:text product_id:text return_quantity:count
        return_amount:money return_reason:label return_channel:label refund_method:label
        receipt_present:flag item_condition:label policy_exception_flag:flag
    """,
    "products": """
        product_id:text product_name:text product_category:label product_subcategory:label
        brand:text unit_price:money cost:money active_flag:flag
    """,
    "stores": """
        store_id:text store_name:text city:text province:code region:text store_type:label
        open_date:date
    """,
    "customers": """
        customer_id:text loyalty_tier:label signup_date:date city:text province:code
    """,
    "employees": """
        employee_id:text store_id:text role:label hire_date:date active_flag:flag
    """,
}

# Spark type of each kind in the strict (decimal) lane.
KIND_TYPES = {
    "text": "string",
    "label": "string",
    "code": "string",
    "date": "date",
    "count": "decimal(10,0)",
    "money": "decimal(10,2)",
    "flag": "boolean",
}

TABLES = tuple(COLUMN_KINDS)
FACTS = ("sales", "returns")
DIMENSIONS = ("products", "stores", "customers", "employees")

# One identifying column per table.
PRIMARY_KEYS = {
    "sales": "sale_id",
    "returns": "return_id",
    "products": "product_id",
    "stores": "store_id",
    "customers": "customer_id",
    "employees": "employee_id",
}

# Accepted categories.
PAYMENT_METHODS = ["credit_card", "debit_card", "cash", "gift_card", "store_credit"]
SALES_CHANNELS = ["in_store", "online", "curbside_pickup"]
RETURN_CHANNELS = ["in_store", "mail", "curbside"]
RETURN_REASONS = [
    "changed_mind", "wrong_size", "defective", "damaged", "not_as_described",
    "duplicate_purchase", "late_delivery", "other",
]

# Business thresholds. The two lanes use different high-value limits.
RETURN_WINDOW_DAYS = 30
STRICT_HIGH_VALUE = "200.00"
LENIENT_HIGH_VALUE = 100.0
HIGH_RETURN_MIN_UNITS = 10
HIGH_RETURN_MIN_RATE = "0.20"
UNUSUAL_MIN_RETURNS = 5
UNUSUAL_TIMES_AVERAGE = 2
DAMAGE_WORDS = ["damaged", "defective"]

# Words read as booleans.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]


def kinds(table: str) -> dict[str, str]:
    """Ordered column -> kind mapping of one input table."""
    return dict(item.split(":") for item in COLUMN_KINDS[table].split())


def columns(table: str) -> list[str]:
    return list(kinds(table))


def raw_ddl(table: str, *, load_metadata: bool = True) -> str:
    """Declared schema of one raw table as a Spark DDL string."""
    fields = [f"{name} {KIND_TYPES[kind]}" for name, kind in kinds(table).items()]
    if load_metadata:
        fields += ["loaded_at timestamp_ntz", "source_file string"]
    return ", ".join(fields)
