"""One checking statement per registered query."""

from __future__ import annotations

import re

from oracle.base import LOADED, derived, lenient, strict, strict_rate
from oracle.operations import operation_statements

SALES = "sale_id, transaction_id, sale_date, store_id, customer_id, employee_id, product_id"
SALE_PRICES = "quantity, unit_price, discount_amount, sale_amount, payment_method, sales_channel"
CONTEXT = """p.product_name, p.product_category, p.product_subcategory, p.brand, st.store_name,
    st.city as store_city, st.province as store_province, st.region as store_region, st.store_type,
    c.loyalty_tier as customer_loyalty_tier, e.role as employee_role"""
JOINS = """left join products p on p.product_id = f.product_id left join stores st on st.store_id = f.store_id
    left join customers c on c.customer_id = f.customer_id
    left join employees e on e.employee_id = f.employee_id"""
SOURCE = lambda table: f"{LOADED}, '{table}.csv' as source_file"


def layers() -> dict[str, str]:
    found = {}
    for table in ("sales", "returns", "products", "stores", "customers", "employees"):
        found[f"stg_{table}"] = derived(f"select *, {SOURCE(table)} from {table}")
        found[f"bronze_{table}"] = derived(f"select *, {SOURCE(table)} from {table}")
        found[f"copy_into_{table}"] = derived(f"select *, true as load_metadata_present from {table}")
    found["int_sales_enriched"] = strict(f"""
        select f.*, {CONTEXT}, p.cost as product_cost, p.active_flag as product_active_flag, {SOURCE("sales")}
        from sold f {JOINS}""")
    found["int_returns_enriched"] = strict(f"select * exclude (has_sale), {SOURCE('returns')} from back_wide")
    found["int_sales_returns_joined"] = strict(f"""
        select f.sale_id, f.transaction_id, f.sale_date, f.store_id, f.customer_id, f.employee_id, f.product_id,
            f.quantity as units_sold, f.unit_price, f.discount_amount, f.gross_sale_amount,
            f.net_sale_amount, f.discount_rate, f.payment_method, f.sales_channel, {CONTEXT},
            f.n as return_count, cast(f.qty as decimal(20,0)) as units_returned,
            cast(f.amount as decimal(20,2)) as return_amount, f.first_day as first_return_date,
            f.last_day as last_return_date, f.n > 0 as returned_flag,
            cast(f.n as decimal(10,0)) as returned_sale_count, cast(1 as decimal(10,0)) as sale_line_count,
            {strict_rate("f.qty", "f.quantity")} as unit_return_rate, f.late as late_return_flag,
            f.bare as no_receipt_flag, f.broken as damaged_or_defective_flag,
            f.high as high_value_return_flag, f.policy as policy_exception_flag
        from matched f {JOINS}""")
    for table in ("products", "stores", "customers", "employees"):
        found[f"silver_{table}"] = lenient(f"select * from silver_{table}")
    found["silver_sales"] = lenient("""
        select sale_id, transaction_id, sale_date, store_id, customer_id, employee_id, product_id,
            cast(quantity as int) as quantity, cast(unit_price as double) as unit_price,
            cast(discount_amount as double) as discount_amount, cast(sale_amount as double) as sale_amount,
            payment_method, sales_channel, cast(gross as double) as gross_sale_amount,
            cast(net as double) as net_sale_amount,
            case when gross > 0 then cast((2 * cast(discount_amount * 100 as bigint) * 10000
                + cast(gross * 100 as bigint)) // (2 * cast(gross * 100 as bigint)) as double) / 10000 end
                as discount_rate
        from silver_sold""")
    found["silver_returns"] = lenient("""
        select * replace (cast(return_quantity as int) as return_quantity,
            cast(return_amount as double) as return_amount) from silver_back""")
    return found


def marts() -> dict[str, str]:
    return {
        "mart_daily_sales_returns_summary": strict("select * from mart_daily"),
        "mart_return_rate_by_product": strict("select * from mart_product"),
        "mart_return_rate_by_store": strict("select * from mart_store"),
        "mart_return_reason_summary": strict("select * from mart_reason"),
        "mart_return_policy_exceptions": strict("select * from mart_exceptions"),
        "mart_employee_return_activity": strict("select * from mart_employee"),
        "gold_daily_sales_returns_summary": lenient("select * from gold_daily"),
        "gold_return_rate_by_product": lenient("select * from gold_product"),
        "gold_return_rate_by_store": lenient("select * from gold_store"),
        "gold_return_reason_summary": lenient("select * from gold_reason"),
        "gold_policy_exceptions": lenient(GOLD_POLICY),
        "gold_employee_return_activity": lenient("select * from gold_employee"),
    }


GOLD_POLICY = "select * exclude (store_type) from gold_policy"


def analysis() -> dict[str, str]:
    return {
        "analysis_overview": lenient("""
            select count(distinct activity_date) as active_dates, cast(sum(sale_count) as bigint) as total_sales,
                cast(sum(return_count) as bigint) as total_returns,
                cast(sum(cast(net_sales_amount as decimal(22,2))) as double) as total_net_sales_amount,
                cast(sum(cast(return_amount as decimal(22,2))) as double) as total_return_amount,
                cast(sum(late_return_count) as bigint) as late_returns,
                cast(sum(no_receipt_return_count) as bigint) as no_receipt_returns,
                cast(sum(high_value_return_count) as bigint) as high_value_returns,
                round(sum(return_amount) / sum(net_sales_amount), 4) as overall_return_rate_by_amount
            from gold_daily"""),
        "analysis_daily_trends": lenient("select * from gold_daily"),
        "analysis_product_returns": lenient("""
            select * from gold_product where return_count > 0
            order by return_amount desc nulls last, return_rate_by_amount desc nulls last, product_id limit 25"""),
        "analysis_store_returns": lenient("""
            select * from gold_store
            order by return_amount desc nulls last, return_rate_by_amount desc nulls last, store_id limit 25"""),
        "analysis_return_reasons": lenient("select * from gold_reason"),
        "analysis_policy_exceptions": lenient(
            GOLD_POLICY + " order by return_amount desc nulls last, return_date desc nulls last, return_id limit 50"),
        "analysis_employee_activity": lenient("""
            select * from gold_employee
            order by return_count desc, policy_exception_count desc, employee_id limit 50"""),
    }


PAGE = """return_id, return_date, store_name, product_name, customer_loyalty_tier, employee_id,
    return_reason, return_amount, days_until_return, exception_reason"""
PAGE_ORDER = "order by return_date desc nulls first, return_amount desc nulls first, return_id limit 500"
CHOSEN = """from mart_exceptions where return_reason in ('damaged', 'wrong_size')
    and (contains(exception_reason, 'late_return') or contains(exception_reason, 'high_value_return'))"""
PRODUCT_SHOWN = """product_id, product_name, product_category, total_units_sold, total_units_returned,
    return_rate, total_return_amount, top_return_reason"""


def reports() -> dict[str, str]:
    grouped = lambda value: f"format('{{:,}}', cast(round_even({value}, 0) as bigint))"
    return {
        "report_kpis": strict(f"""
            select *, {grouped("total_sales")} as total_sales_text,
                '$' || {grouped("total_sales_amount")} as total_sales_amount_text,
                '$' || {grouped("net_revenue")} as net_revenue_text,
                {grouped("total_returns")} as total_returns_text,
                '$' || {grouped("total_return_amount")} as total_return_amount_text,
                format('{{:.1f}}%', overall_return_rate * 100) as overall_return_rate_text
            from (
                select cast(sum(total_sales) as bigint) as total_sales,
                    cast(sum(total_sales_amount) as decimal(22,2)) as total_sales_amount,
                    cast(sum(total_returns) as bigint) as total_returns,
                    cast(sum(total_return_amount) as decimal(22,2)) as total_return_amount,
                    cast(sum(net_revenue_after_returns) as decimal(22,2)) as net_revenue,
                    case when sum(total_sales) <> 0
                        then cast(sum(total_returns) as double) / cast(sum(total_sales) as double) else 0 end
                        as overall_return_rate
                from mart_daily
            )"""),
        "report_daily_trends": strict("""
            select cast(calendar_date as timestamp) as calendar_date, total_sales_amount, total_return_amount,
                return_rate from mart_daily"""),
        "report_top_products_by_rate": strict("""
            select product_id, coalesce(product_name, product_id) as product_label, return_rate, total_units_sold
            from mart_product order by return_rate desc, total_units_sold desc, product_id limit 10"""),
        "report_top_products_by_amount": strict("""
            select product_id, coalesce(product_name, product_id) as product_label, total_return_amount
            from mart_product order by total_return_amount desc, product_id limit 10"""),
        "report_high_return_products": strict(
            f"select {PRODUCT_SHOWN} from mart_product where high_return_product_flag"),
        "report_store_rates_long": strict("""
            select coalesce(store_name, store_id) as store_label, 'Return rate' as metric, return_rate as rate
            from mart_store
            union all select coalesce(store_name, store_id), 'Policy exception rate', policy_exception_rate
            from mart_store
            union all select coalesce(store_name, store_id), 'No-receipt return rate', no_receipt_return_rate
            from mart_store"""),
        "report_store_table": strict("""
            select store_id, store_name, store_city, store_region, total_sales, total_returns, return_rate,
                policy_exception_rate, no_receipt_return_rate from mart_store"""),
        "report_return_reasons": strict("select * from mart_reason"),
        "report_exception_page": strict(f"select {PAGE} from mart_exceptions {PAGE_ORDER}"),
        "report_exception_filter": strict(f"select {PAGE} {CHOSEN} {PAGE_ORDER}"),
        "report_exception_kpis": strict(f"""
            select count(*) as filtered_returns,
                cast(coalesce(sum(return_amount), 0) as decimal(22,2)) as filtered_return_amount {CHOSEN}"""),
        "report_exception_counts": strict("""
            select exception_type, count(*) as return_count
            from (select unnest(string_split(exception_reason, ', ')) as exception_type from mart_exceptions)
            group by 1"""),
        "report_exception_types": strict("""
            select distinct trim(t) as exception_type
            from (select unnest(string_split(exception_reason, ',')) as t from mart_exceptions)
            where trim(t) <> ''"""),
        "report_filter_choices": strict(
            "select distinct store_name from mart_exceptions where store_name is not null"),
        "report_top_employees": strict("""
            select employee_id, total_returns_processed, unusual_return_activity_flag from mart_employee
            order by total_returns_processed desc, employee_id limit 15"""),
        "report_employee_scatter": strict("""
            select employee_id, employee_role, total_returns_processed, policy_exception_returns_processed,
                no_receipt_returns_processed, average_return_amount, unusual_return_activity_flag
            from mart_employee"""),
        "report_unusual_employees": strict("""
            select employee_id, store_id, employee_role, total_returns_processed, total_return_amount_processed,
                policy_exception_returns_processed, no_receipt_returns_processed, average_return_amount
            from mart_employee where unusual_return_activity_flag"""),
    }


# Checking name of each model.
MODEL_TABLES = {
    **{f"stg_{t}": t for t in ("sales", "returns", "products", "stores", "customers", "employees")},
    "raw_sales": "sales",
    "raw_returns": "returns",
    "int_sales_enriched": "sold",
    "int_returns_enriched": "back_wide",
    "int_sales_returns_joined": "joined_rows",
    "mart_daily_sales_returns_summary": "mart_daily",
    "mart_return_rate_by_product": "mart_product",
    "mart_return_rate_by_store": "mart_store",
    "mart_return_reason_summary": "mart_reason",
    "mart_return_policy_exceptions": "mart_exceptions",
    "mart_employee_return_activity": "mart_employee",
}
JOINED_ROWS = """, joined_rows as (
    select sale_id, n > 0 as returned_flag, n as return_count, qty / quantity as unit_return_rate from matched
)"""


def check(rule: str, model: str, column: str, rows: str, violations: str, source: str) -> str:
    return (
        f"select '{rule}' as rule, '{model}' as table_name, '{column}' as column_name, "
        f"cast({rows} as bigint) as rows_checked, cast({violations} as bigint) as violations from {source}"
    )


def quality() -> dict[str, str]:
    from tillback.plans.checks import ACCEPTED, NOT_EMPTY, NOT_NULL, PARENTS, UNIQUE
    from tillback.domains import PRIMARY_KEYS, TABLES

    def unique_check(model: str, column: str, table: str) -> str:
        counted = f"(select {column} as v, count(*) as n from {table} group by 1)"
        return check("unique", model, column, "sum(n)", "count(*) filter (n > 1 and v is not null)", counted)

    def parent_check(model: str, column: str, table: str, parent: str, key: str) -> str:
        orphan = f"{column} is not null and {column} not in (select {key} from {parent} where {key} is not null)"
        return check("relationships", model, column, "count(*)", f"count(*) filter ({orphan})", table)

    def joined(parts) -> str:
        return strict(JOINED_ROWS + "\n" + " union all ".join(parts))

    def quoted(values) -> str:
        return ", ".join(f"'{value}'" for value in values)

    found = {
        "quality_not_null": joined(
            check("not_null", model, column, "count(*)", f"count(*) filter ({column} is null)", MODEL_TABLES[model])
            for model, names in NOT_NULL.items() for column in names.split()),
        "quality_unique": joined(unique_check(m, c, MODEL_TABLES[m]) for m, c in UNIQUE.items()),
        "quality_accepted_values": joined(
            check("accepted_values", model, column, "count(*)",
                  f"count(*) filter ({column} not in ({quoted(values)}))", MODEL_TABLES[model])
            for model, rules in ACCEPTED.items() for column, values in rules.items()),
        "quality_relationships": joined(
            parent_check(model, column, MODEL_TABLES[model], parent, PRIMARY_KEYS[parent])
            for model, parents in PARENTS.items() for column, parent in parents.items()),
        "quality_not_empty": joined(
            check("not_empty", model, "*", "count(*)", "case when count(*) = 0 then 1 else 0 end", MODEL_TABLES[model])
            for model in NOT_EMPTY),
        "quality_unique_transactions": derived(unique_check("stg_sales", "transaction_id", "sales")),
        "quality_fk_subset": derived(parent_check("returns", "sale_id", "returns", "sales", "sale_id")),
        "quality_row_counts": derived(" union all ".join(
            f"select 'silver_{t}' as table_name, count(*) as row_count from {t}" for t in TABLES)),
        "union_all_counts": derived(" union all ".join(
            f"select '{t.upper()}_RAW' as table_name, count(*) as row_count from {t}" for t in TABLES)),
        "quality_exact_columns": derived(" union all ".join(
            f"select '{t}' as table_name, true as columns_match, count(*) as row_count from {t}" for t in TABLES)),
        "quality_missing_primary_keys": derived(" union all ".join(
            check("missing_primary_key", f"silver_{t}", k, "count(*)", f"count(*) filter ({k} is null)", t)
            for t, k in PRIMARY_KEYS.items())),
        "quality_negative_amounts": derived(" union all ".join(
            check("negative_amount", f"silver_{t}", a, "count(*)", f"count(*) filter ({a} < 0)", t)
            for t, a in (("sales", "sale_amount"), ("returns", "return_amount")))),
        "quality_returns_before_sale": strict(check(
            "returns_before_sale", "silver_returns", "return_date", "count(*)",
            "count(*) filter (return_date < sale_date)", "back")),
        "quality_return_date_ge_sale_date": strict(check(
            "return_date_ge_sale_date", "returns", "return_date", "count(*)",
            "count(*) filter (not coalesce(return_date >= sale_date, false))", "back")),
    }
    return found


def operators() -> dict[str, str]:
    days = """select coalesce(s.day, r.day) as day, coalesce(s.sold, 0) as sold, coalesce(r.back, 0) as back
        from (select sale_date as day, count(*) as sold from sales group by 1) s
        full join (select return_date as day, count(*) as back from returns group by 1) r on r.day = s.day"""
    handled = """handled_by as (
        select e.employee_id, e.store_id, count(r.return_id) as handled
        from employees e left join returns r on r.employee_id = e.employee_id group by all
    )"""
    return {
        "full_join_using": derived(days),
        "spine_left_joins": derived(days),
        "union_distinct": derived("select sale_date as calendar_date from sales union select return_date from returns"),
        "scalar_threshold": derived(
            "select *, handled > (select avg(handled) from handled_by) as above_average from handled_by", handled),
        "row_number_top1": derived("""
            select product_id, return_reason, count(*) as reason_return_count from returns
            group by product_id, return_reason qualify row_number() over (
                partition by product_id order by count(*) desc, sum(return_amount) desc, return_reason) = 1"""),
        "share_of_total": derived(f"""
            select store_id, count(*) as returns, {strict_rate("count(*)", "(select count(*) from returns)")} as share
            from returns group by store_id"""),
        "normalize_within_group": derived("""
            select *, cast(handled as double) / nullif(sum(handled) over (partition by store_id), 0) as share
            from handled_by""", handled),
        "quantile_threshold": derived("""
            select 'selection' as limit_name, cast(greatest(150, quantile_cont(cast(sale_amount as double), 0.90))
                as decimal(20,6)) as value from sales
            union all
            select 'event', cast(greatest(200, quantile_cont(cast(return_amount as double), 0.92))
                as decimal(20,6)) from returns"""),
        "members_by_group": derived("""
            select store_id, count(*) as members, cast(0 as bigint) as first_no, count(*) - 1 as last_no,
                count(*) as numbers, count(*) as member_count, min(employee_id) as first_employee
            from employees group by store_id"""),
        "temp_view_query": strict("""
            select store_region, count(*) as stores, cast(sum(total_returns) as bigint) as total_returns
            from mart_store group by 1"""),
        "copy_into_incremental": derived("select *, true as load_metadata_present from returns"),
        "list_stage": """
            select distinct table_name || '.parquet' as file_name, true as has_content
            from information_schema.tables where table_name in ('region', 'nation', 'customer', 'supplier', 'part',
                'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels',
                'conversations')""",
    }


# Rows listed twice and values spoiled in the faulty variants; kept apart from the plans they check.
TWICE = {
    "sales": "quantity = 13", "products": "product_category = 'beauty'", "stores": "store_type = 'mall'",
    "customers": "loyalty_tier = 'gold'", "employees": "role = 'manager'",
}


def with_repeats(body: str) -> str:
    """A strict statement over tables with repeated rows, whose facts join every dimension."""
    text = strict(body)

    def insert(name: str, once: str, then: str) -> None:
        nonlocal text
        text, found = re.subn(
            rf"(^|\n|,|with ){name} as \((.*?)\n\)", lambda m: f"{m[1]}{once} as ({m[2]}\n),\n{name} as ({then})", text, count=1, flags=re.DOTALL
        )
        assert found, name

    for name, condition in TWICE.items():
        insert(name, f"{name}_once", f"select * from {name}_once union all select * from {name}_once where {condition}")
    joins = " ".join(
        f"left join (select {key} as d{n} from {table}) t{n} on t{n}.d{n} = f.{key}"
        for n, (table, key) in enumerate((("products", "product_id"), ("stores", "store_id"), ("customers", "customer_id"), ("employees", "employee_id")))
    )
    for name in ("sold", "back"):
        insert(name, f"{name}_once", f"select f.* from {name}_once f {joins}")
    return text


SPOILED = """
spoiled_sales as (
    select * replace (
        case when quantity = 17 then null else sale_id end as sale_id,
        case when quantity = 19 then cast(-sale_amount as decimal(10,2)) else sale_amount end as sale_amount,
        case when quantity = 23 then 'shells' else payment_method end as payment_method,
        case when quantity = 29 then 'TXN-repeated' else transaction_id end as transaction_id) from sales
),
spoiled_returns as (
    select * replace (
        case when return_reason = 'defective' then 'gone-' || sale_id else sale_id end as sale_id,
        case when return_reason = 'wrong_size' then date '1990-01-01' else return_date end as return_date,
        case when return_reason = 'other' then null else return_id end as return_id,
        case when return_reason = 'damaged' then cast(-return_amount as decimal(10,2)) else return_amount end
            as return_amount) from returns
)"""


def faulty() -> dict[str, str]:
    """Marts over repeated keys, and violations over spoiled tables."""
    marts_of = {
        "mart_daily_sales_returns_summary": "mart_daily", "mart_return_rate_by_product": "mart_product",
        "mart_return_rate_by_store": "mart_store", "mart_return_reason_summary": "mart_reason",
        "mart_employee_return_activity": "mart_employee",
    }
    found = {f"{name}_repeated_keys": with_repeats(f"select * from {cte}") for name, cte in marts_of.items()}
    orphans = """select r.sale_id as key, count(*) as rows from spoiled_returns r
        where r.sale_id is not null and not exists (select 1 from spoiled_sales s where s.sale_id = r.sale_id) group by 1"""
    bodies = {
        "violations_null_sale_ids": "select transaction_id, product_id, store_id, sale_date from spoiled_sales where sale_id is null",
        "violations_repeated_transactions": """select transaction_id, count(*) as rows from spoiled_sales
            where transaction_id is not null group by 1 having count(*) > 1""",
        "violations_payment_methods": "select sale_id, payment_method from spoiled_sales where payment_method = 'shells'",
        "violations_orphan_returns": orphans,
        "violations_negative_amounts": "select return_id, return_amount from spoiled_returns where return_amount < 0",
        "violations_early_returns": """select r.return_id, s.sale_date, r.return_date
            from spoiled_returns r join spoiled_sales s on r.sale_id = s.sale_id where r.return_date < s.sale_date""",
        "quality_summary_spoiled": f"""
            select 'not_null' as rule, 'sales' as table_name, 'sale_id' as column_name, count(*) as rows_checked,
                count(*) filter (where sale_id is null) as violations from spoiled_sales
            union all select 'not_null', 'sales', 'sale_date', count(*), count(*) filter (where sale_date is null) from spoiled_sales
            union all select 'not_null', 'returns', 'return_id', count(*), count(*) filter (where return_id is null) from spoiled_returns
            union all select 'unique', 'sales', 'transaction_id', sum(n)::bigint, count(*) filter (where n > 1 and transaction_id is not null)
                from (select transaction_id, count(*) as n from spoiled_sales group by 1)
            union all select 'accepted_values', 'sales', 'payment_method', count(*),
                count(*) filter (where payment_method = 'shells') from spoiled_sales
            union all select 'relationships', 'returns', 'sale_id', (select count(*) from spoiled_returns),
                (select coalesce(sum(rows), 0)::bigint from ({orphans}))
            union all select 'not_empty', 'no_sales', '*', 0, 1""",
    }
    return found | {name: derived(body, SPOILED) for name, body in bodies.items()}


def statements() -> dict[str, str]:
    found = {**layers(), **marts(), **analysis(), **reports(), **quality(), **operators(), **faulty(), **operation_statements()}
    same = {"report_required_inputs": "report_kpis", "published_mart": "mart_return_rate_by_store", "raw_ddl_table": "bronze_stores"}
    return found | {name: found[other] for name, other in same.items()}
