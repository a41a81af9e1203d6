"""Checking statements for loads, whole lanes, incremental marts, baselines and monitoring."""

from __future__ import annotations

import re

from oracle.base import cents, derived, lenient, rounded_ratio, strict, strict_rate
from oracle.rules import rule_statements

TABLES = ("sales", "returns", "products", "stores", "customers", "employees")

LATE = """, late_sales as (
    select * from sales where month(sale_date) = 3 and day(sale_date) <= 7 and cast(quantity as int) % 5 = 0
),
late_returns as (
    select * from returns where month(return_date) = 5 and day(return_date) <= 9 and return_reason = 'damaged'
)"""
JOINED_ROWS = """, joined_rows as (
    select sale_id, n > 0 as returned_flag, n as return_count, qty / quantity as unit_return_rate from matched
)"""


def incremental() -> dict[str, str]:
    return {
        "mart_daily_incremental": strict(LATE + """, affected as (
                select date_trunc('month', sale_date) as month from late_sales
                union select date_trunc('month', return_date) from late_returns
            )
            select m.*, case when a.month is null then 1 else 2 end as built_by
            from mart_daily m left join affected a on a.month = date_trunc('month', m.calendar_date)"""),
        "mart_exceptions_incremental": strict(LATE + """, affected as (
                select date_trunc('month', return_date) as month from late_returns
                union select date_trunc('month', return_date) from returns where sale_id in (select sale_id from late_sales)
            )
            select return_id, sale_id, sale_date, return_date, days_until_return, return_amount, return_reason, late_return_flag,
                no_receipt_flag, damaged_or_defective_flag, high_value_return_flag, policy_exception_flag, exception_reason,
                case when a.month is null then 1 else 2 end as built_by
            from mart_exceptions m left join affected a on a.month = date_trunc('month', m.return_date)"""),
    }


def rolling(entity: str) -> str:
    return derived(f"""
        , days as (
            select entity_id, activity_date, sum(s) as sold, sum(r) as back from (
                select {entity} as entity_id, sale_date as activity_date, 1 as s, 0 as r from sales
                union all select {entity}, return_date, 0, 1 from returns
            ) group by all
        ),
        rolled as (
            select *, coalesce(sum(sold) over w, 0) as base_sold, coalesce(sum(back) over w, 0) as base_back, count(*) over w as base_days
            from days window w as (
                partition by entity_id order by activity_date range between interval 30 days preceding and interval 1 day preceding
            )
        )
        select '{entity}' as entity, entity_id, activity_date, sold::bigint as sales, back::bigint as returns,
            {strict_rate("back", "sold")} as return_rate, base_sold::bigint as baseline_sales, base_back::bigint as baseline_returns,
            base_days as baseline_days, {strict_rate("base_back", "base_sold")} as baseline_rate,
            {strict_rate("base_back", "30")} as baseline_returns_a_day,
            sold > 0 and base_sold > 0 and back * base_sold > base_back * sold as above_baseline
        from rolled""")


PEERS = strict(f"""
    , rated as (
        select store_id, store_type, total_returns, total_sales, {rounded_ratio("total_returns", "total_sales", 6)} as rate from mart_store
    ),
    moments as (
        select store_type, count(rate) as n, sum(rate) as s, sum(rate * rate) as q from rated group by 1
    ),
    scored as (
        select rated.*, n, s, case when n > 1 and n * q - s * s > 0 then
            round(cast(n * rate - s as double) * sqrt(cast(n - 1 as double) / n) / sqrt(cast(n * q - s * s as double)), 4) end as z
        from rated join moments on rated.store_type is not distinct from moments.store_type
    )
    select store_id, store_type as peer_group, n as peers, total_returns, total_sales,
        cast(cast(rate as double) / 1000000 as decimal(12,6)) as rate,
        cast(cast({rounded_ratio("s", "n * 1000000", 4)} as double) / 10000 as decimal(10,4)) as peer_mean,
        cast(z as decimal(10,4)) as z_score, coalesce(z >= 2 and n >= 3, false) as above_peers
    from scored""")


def trend() -> str:
    loads = []
    for load in (1, 2, 3):
        for table in TABLES:
            condition = {
                "sales": f"where cast(quantity as int) % 3 <= {load - 1}", "returns": f"where cast(return_quantity as int) % 3 = {load - 1}",
            }.get(table, "")
            loads.append(f"select {load} as load_no, '{table}' as table_name, count(*) as row_count from {table} {condition}")
    change = strict_rate("abs(row_count * earlier - total)", "total")
    return derived(f"""
        , loads as ({" union all ".join(loads)}),
        seen as (
            select *, count(*) over w as earlier, sum(row_count) over w as total,
                row_count - lag(row_count) over (partition by table_name order by load_no) as rows_since
            from loads window w as (partition by table_name order by load_no rows between 7 preceding and 1 preceding)
        ),
        changed as (select *, cast(sign(row_count * earlier - total) * {change} as decimal(10,4)) as change from seen)
        select cast(load_no as int) as load_no, table_name, row_count, earlier as earlier_loads, rows_since,
            cast(cast({rounded_ratio("total", "earlier", 4)} as double) / 10000 as decimal(24,4)) as trailing_mean, change,
            coalesce(abs(change) > 0.5, false) as unusual_count,
            case when row_count > 0 then 24 end::bigint as age_hours, row_count = 0 as stale
        from changed""")


def counts(pairs: dict[str, str], wrap) -> str:
    return wrap(JOINED_ROWS * (wrap is strict) + " " + " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, count(*) > 0 as readable from {table}" for name, table in pairs.items()
    ))


STRICT_TABLES = {
    "int_sales_enriched": "sold", "int_returns_enriched": "back_wide", "int_sales_returns_joined": "joined_rows",
    "mart_daily_sales_returns_summary": "mart_daily", "mart_return_rate_by_product": "mart_product",
    "mart_return_rate_by_store": "mart_store", "mart_return_reason_summary": "mart_reason",
    "mart_return_policy_exceptions": "mart_exceptions", "mart_employee_return_activity": "mart_employee",
}
GOLD_TABLES = {
    "gold_daily_sales_returns_summary": "gold_daily", "gold_return_rate_by_product": "gold_product",
    "gold_return_rate_by_store": "gold_store", "gold_return_reason_summary": "gold_reason",
    "gold_policy_exceptions": "gold_policy", "gold_employee_return_activity": "gold_employee",
}


def lanes() -> dict[str, str]:
    lake = {f"{layer}_{table}": table for layer in ("bronze", "silver") for table in TABLES} | GOLD_TABLES
    layers = [
        f"""select '{t}' as table_name, count(*) as raw_rows, count(*) as bronze_rows, count(*) as silver_rows,
            null::bigint as gold_rows, 0::bigint as lost_rows from {t}""" for t in TABLES
    ] + [f"select '{name}', null, null, null, count(*), null from {table}" for name, table in GOLD_TABLES.items()]
    return {
        "strict_lane_tables": counts(STRICT_TABLES, strict),
        "lenient_lane_tables": counts(lake, lenient),
        "layer_row_counts": lenient(" union all ".join(layers)),
    }


DOUBLED = """select * from returns_once union all
    select * replace ('S1' as store_id, 'E1-1' as employee_id,
        case when return_reason = 'damaged' then 'damaged' else 'other' end as return_reason)
    from returns_once where return_reason in ('damaged', 'wrong_size')"""
SPOILED = {
    "sales": """select * replace (
        case when quantity = 17 then null else sale_id end as sale_id,
        case when quantity = 19 then cast(-sale_amount as decimal(10,2)) else sale_amount end as sale_amount,
        case when quantity = 23 then 'shells' else payment_method end as payment_method,
        case when quantity = 29 then 'TXN-repeated' else transaction_id end as transaction_id) from sales_once""",
    "returns": """select * replace (
        case when return_reason = 'defective' then 'gone-' || sale_id else sale_id end as sale_id,
        case when return_reason = 'wrong_size' then date '1990-01-01' else return_date end as return_date,
        case when return_reason = 'other' then null else return_id end as return_id,
        case when return_reason = 'damaged' then cast(-return_amount as decimal(10,2)) else return_amount end
            as return_amount) from returns_once""",
}


def replaced(text: str, table: str, body: str) -> str:
    """The statement with a derived table put in place of the one of that name."""
    text, found = re.subn(
        rf"(\n|,|with ){table} as \((.*?)\n\)", lambda m: f"{m[1]}{table}_once as ({m[2]}\n),\n{table} as ({body})", text, count=1, flags=re.DOTALL
    )
    assert found, table
    return text


def variants() -> dict[str, str]:
    found = {
        f"{name}_doubled": replaced(lenient(f"select * from {GOLD_TABLES[name]}"), "returns", DOUBLED)
        for name in GOLD_TABLES if name != "gold_policy_exceptions"
    }
    every = strict(JOINED_ROWS + "\n" + " union all ".join(rule_statements()))
    spoiled = every
    for table, body in SPOILED.items():
        spoiled = replaced(spoiled, table, body)
    return found | {"quality_all": every, "quality_all_spoiled": spoiled}


HOT_KEYS = derived("""
    , hot as (
        select return_id,
            case when cast(return_quantity as int) % 5 < 2 then null when return_reason = 'defective' then 'gone-' || sale_id else sale_id end as sale_id,
            case when cast(return_quantity as int) % 3 = 0 then 'P1' else product_id end as product_id
        from returns
    )
    select hot.return_id, hot.sale_id, hot.product_id, sales.sale_date, products.product_category
    from hot left join sales on sales.sale_id = hot.sale_id left join products on products.product_id = hot.product_id""")

CHECKED = derived("""
    select 'first' as landing, count(*) filter (return_reason = 'other') as rows_loaded, 0::bigint as bad_rows, true as files_told,
        count(*) filter (return_reason = 'other') as rows_in_table from returns
    union all
    select 'spoiled', 0, count(*) filter (return_reason = 'late_delivery'), true, count(*) filter (return_reason = 'other') from returns
    union all
    select 'whole', count(*), 0, true, count(*) from returns""")

SAMPLE = derived(f"""
    , drawn as (
        select sale_id, sale_amount, -ln(greatest(cast(('0x' || substr(md5('42|sample|' || sale_id), 1, 13))::bigint as double)
            / 4503599627370496, 1e-18)) / (greatest(cast({cents("sale_amount")} as double) / 100, 0.01) / 1000) as arrival
        from sales
    )
    select sale_id, sale_amount from drawn
    qualify row_number() over (order by arrival, sale_id) <= (select count(*) // 10 from sales)""")


def more_reports() -> dict[str, str]:
    return {
        "report_store_filter": strict("""
            select store_name, return_reason, count(*) as returns, cast(sum(return_amount) as decimal(20,2)) as return_amount
            from mart_exceptions where store_name in (
                select distinct store_name from mart_exceptions where store_name is not null order by 1 limit 3
            ) group by 1, 2"""),
        "report_filter_reasons": strict("select distinct return_reason from mart_exceptions where return_reason is not null"),
        "report_missing_columns": """
            select * from (values ('stores', 'policy_exception_rate'), ('stores', 'no_receipt_return_rate'), ('employees', 'employee_role'))
                as t(report_table, missing_column)""",
        "report_exception_labels": strict("""
            select array_to_string(list_transform(string_split(t, '_'), lambda w: upper(w[1]) || w[2:]), ' ') as exception_label,
                count(*) as return_count
            from (select unnest(string_split(exception_reason, ', ')) as t from mart_exceptions) group by 1"""),
        "zero_padded_ids": derived("""
            select product_id, 'PRD' || lpad(substr(product_id, 2), 6, '0') as padded_id from products"""),
        "quality_forbidden_columns": """
            select * from (values ('stores', 'store_name'), ('products', 'product_name')) as t(table_name, column_name)""",
    }


def operation_statements() -> dict[str, str]:
    return {
        **incremental(), **lanes(), **variants(), **more_reports(),
        "rolling_return_rate_store": rolling("store_id"),
        "rolling_return_rate_product": rolling("product_id"),
        "store_peer_z": PEERS,
        "load_trend": trend(),
        "attach_hot_keys": HOT_KEYS,
        "copy_into_checked": CHECKED,
        "weighted_sample": SAMPLE,
    }
