"""The quality rules that hold for the strict lane, written out for checking: one line per model.

``!`` columns have no nulls, ``*`` is unique, ``column=a|b`` has a closed list, ``column>table.key``
refers to a parent, ``+`` must have rows.
"""

from __future__ import annotations

REASONS = "changed_mind|wrong_size|defective|damaged|not_as_described|duplicate_purchase|late_delivery|other"

# Model, checking table, rules.
RULES = f"""
raw_sales sales +
raw_returns returns +
stg_sales sales !sale_id !sale_amount *sale_id payment_method=credit_card|debit_card|cash|gift_card|store_credit sales_channel=in_store|online|curbside_pickup +
stg_returns returns !return_id !return_amount *return_id return_reason={REASONS} return_channel=in_store|mail|curbside +
stg_products products !product_id *product_id
stg_stores stores !store_id *store_id
stg_customers customers !customer_id *customer_id
stg_employees employees !employee_id *employee_id
int_sales_enriched sold !sale_id !product_id !store_id !customer_id !employee_id !net_sale_amount !discount_rate *sale_id sale_id>sales.sale_id product_id>products.product_id store_id>stores.store_id customer_id>customers.customer_id employee_id>employees.employee_id
int_returns_enriched back_wide !return_id !sale_id !return_amount !return_reason *return_id return_reason={REASONS} return_id>returns.return_id sale_id>sales.sale_id
int_sales_returns_joined joined_rows !sale_id !returned_flag !return_count !unit_return_rate *sale_id sale_id>sales.sale_id
mart_daily_sales_returns_summary mart_daily !calendar_date !total_sales !total_sales_amount !total_returns !total_return_amount !return_rate !net_revenue_after_returns *calendar_date +
mart_return_rate_by_product mart_product !product_id !total_units_sold !total_sales_amount !total_units_returned !total_return_amount !return_rate !high_return_product_flag *product_id product_id>products.product_id +
mart_return_rate_by_store mart_store !store_id !total_sales !total_sales_amount !total_returns !total_return_amount !return_rate !no_receipt_return_rate !policy_exception_rate *store_id store_id>stores.store_id +
mart_return_reason_summary mart_reason !return_reason !total_returns !total_return_amount !percent_of_returns !average_return_amount *return_reason return_reason={REASONS}
mart_return_policy_exceptions mart_exceptions !return_id !sale_id !exception_reason !return_reason *return_id return_reason={REASONS} return_id>returns.return_id sale_id>sales.sale_id +
mart_employee_return_activity mart_employee !employee_id !total_returns_processed !total_return_amount_processed !no_receipt_returns_processed !policy_exception_returns_processed !average_return_amount !unusual_return_activity_flag *employee_id employee_id>employees.employee_id
"""


def summary_row(rule: str, model: str, column: str, rows: str, violations: str, source: str) -> str:
    return (
        f"select '{rule}' as rule, '{model}' as table_name, '{column}' as column_name, "
        f"cast({rows} as bigint) as rows_checked, cast({violations} as bigint) as violations from {source}"
    )


def rule_statements() -> list[str]:
    found = []
    for line in RULES.strip().splitlines():
        model, table, *rules = line.split()
        for rule in rules:
            if rule.startswith("!"):
                found.append(summary_row("not_null", model, rule[1:], "count(*)", f"count(*) filter ({rule[1:]} is null)", table))
            elif rule.startswith("*"):
                counted = f"(select {rule[1:]} as v, count(*) as n from {table} group by 1)"
                found.append(summary_row("unique", model, rule[1:], "coalesce(sum(n), 0)", "count(*) filter (n > 1 and v is not null)", counted))
            elif "=" in rule:
                column, values = rule.split("=")
                listed = ", ".join(f"'{value}'" for value in values.split("|"))
                found.append(summary_row("accepted_values", model, column, "count(*)", f"count(*) filter ({column} not in ({listed}))", table))
            elif ">" in rule:
                column, parent = rule.split(">")
                parent, key = parent.split(".")
                orphan = f"{column} is not null and not exists (select 1 from {parent} q where q.{key} = c.{column})"
                found.append(summary_row("relationships", model, column, "count(*)", f"count(*) filter ({orphan})", f"{table} c"))
            elif model.startswith("raw_"):  # only presence is asked of these, so only one row is looked at
                found.append(summary_row("not_empty", model, "*", "least(count(*), 1)", "case when count(*) = 0 then 1 else 0 end", table))
            else:
                found.append(summary_row("not_empty", model, "*", "count(*)", "case when count(*) = 0 then 1 else 0 end", table))
    return found
