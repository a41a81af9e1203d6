"""Shared SQL text for checking queries in another engine: derived tables and both lanes.

Every checking statement is one SELECT behind the WITH prefixes below. Rates are computed with
whole-number arithmetic, so that no engine's decimal or floating rounding enters the result.
"""

from __future__ import annotations

DERIVED = """
lines as (
    select l_orderkey as ok, l_partkey as pk, l_suppkey as sk, l_linenumber as ln, l_returnflag as rf,
        o_orderpriority as prio,
        'SL' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
            || (year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)) || '-'
            || cast(l_quantity as int) as sale_id,
        'TXN' || l_orderkey as transaction_id, cast(l_shipdate as date) as sale_date,
        'S' || l_suppkey as store_id, 'C' || o_custkey as customer_id, 'P' || l_partkey as product_id,
        cast(l_quantity as decimal(10,0)) as quantity,
        cast(cast(p_retailprice as decimal(10,2)) * cast(0.02 as decimal(3,2)) as decimal(10,2)) as unit_price,
        cast(l_discount as decimal(4,2)) as disc
    from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
),
sale_lines as (
    select *, cast(unit_price * quantity * disc as decimal(10,2)) as discount_amount,
        case prio when '1-URGENT' then 'credit_card' when '2-HIGH' then 'debit_card'
            when '3-MEDIUM' then 'cash' when '4-NOT SPECIFIED' then 'gift_card' else 'store_credit' end
            as payment_method,
        case ln % 3 when 0 then 'in_store' when 1 then 'online' else 'curbside_pickup' end as sales_channel
    from lines
),
sales as (
    select sale_id, transaction_id, sale_date, store_id, customer_id, 'E' || sk || '-' || ln as employee_id,
        product_id, quantity, unit_price, discount_amount,
        cast(unit_price * quantity - discount_amount as decimal(10,2)) as sale_amount,
        payment_method, sales_channel
    from sale_lines
),
returns as (
    select 'RT' || substr(sale_id, 3) as return_id, sale_id, transaction_id,
        sale_date + cast((ok * 13 + pk * 7) % 45 as int) as return_date, store_id, customer_id,
        'E' || sk || '-' || (1 + (((ok * ok + pk) % 7) * (ok % 3)) % 7) as employee_id, product_id,
        cast(1 + ok % cast(quantity as bigint) as decimal(10,0)) as return_quantity,
        cast(unit_price * (1 - disc) * cast(1 + ok % cast(quantity as bigint) as decimal(10,0))
            as decimal(10,2)) as return_amount,
        case (pk + ln) % 8 when 0 then 'changed_mind' when 1 then 'wrong_size' when 2 then 'defective'
            when 3 then 'damaged' when 4 then 'not_as_described' when 5 then 'duplicate_purchase'
            when 6 then 'late_delivery' else 'other' end as return_reason,
        case ok % 3 when 0 then 'in_store' when 1 then 'mail' else 'curbside' end as return_channel,
        case when ok % 7 <> 0 then payment_method else 'store_credit' end as refund_method,
        ok % 7 <> 0 as receipt_present,
        case ok % 5 when 0 then 'unopened' when 1 then 'opened' when 2 then 'damaged'
            when 3 then 'defective' else 'missing_packaging' end as item_condition,
        ok % 11 = 0 as policy_exception_flag
    from sale_lines
    where rf = 'R' and (pk % 4 = 0 or (pk + ok) % 3 = 0)
),
products as (
    select 'P' || p_partkey as product_id, p_name as product_name,
        case p_type when 'ECONOMY' then 'grocery' when 'SMALL' then 'beauty' when 'MEDIUM' then 'home'
            when 'PROMO' then 'apparel' when 'STANDARD' then 'sporting_goods' else 'electronics' end
            as product_category,
        'sub_' || (p_size % 5) as product_subcategory, p_brand as brand,
        cast(cast(p_retailprice as decimal(10,2)) * cast(0.02 as decimal(3,2)) as decimal(10,2)) as unit_price,
        cast(cast(p_retailprice as decimal(10,2)) * cast(0.012 as decimal(4,3)) as decimal(10,2)) as cost,
        p_partkey % 25 <> 0 as active_flag
    from part
),
stores as (
    select 'S' || s_suppkey as store_id, s_name as store_name, n_name as city, 'P' || n_regionkey as province,
        r_name as region,
        case s_suppkey % 5 when 0 then 'flagship' when 1 then 'mall' when 2 then 'outlet'
            when 3 then 'neighbourhood' else 'warehouse' end as store_type,
        date '2010-01-01' + cast(s_suppkey % 5000 as int) as open_date
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
),
customers as (
    select 'C' || c_custkey as customer_id,
        case c_mktsegment when 'HOUSEHOLD' then 'none' when 'MACHINERY' then 'bronze'
            when 'FURNITURE' then 'silver' when 'BUILDING' then 'gold' else 'platinum' end as loyalty_tier,
        date '2018-01-01' + cast(c_custkey % 2900 as int) as signup_date, n_name as city,
        'P' || n_regionkey as province
    from customer join nation on c_nationkey = n_nationkey
),
employees as (
    select distinct 'E' || l_suppkey || '-' || l_linenumber as employee_id, 'S' || l_suppkey as store_id,
        case l_linenumber when 1 then 'sales_associate' when 2 then 'cashier' when 3 then 'customer_service'
            when 4 then 'returns_specialist' when 5 then 'stock_associate' when 6 then 'supervisor'
            else 'manager' end as role,
        date '2018-01-01' + cast((l_suppkey * 7 + l_linenumber) % 2900 as int) as hire_date,
        (l_suppkey * 7 + l_linenumber) % 10 <> 0 as active_flag
    from lineitem
)"""

LOADED = "timestamp '2025-01-01 00:00:00' as loaded_at"


def cents(amount: str) -> str:
    return f"cast(({amount}) * 100 as bigint)"


def rounded_ratio(a: str, b: str, digits: int) -> str:
    """a / b rounded half up to ``digits`` decimals, scaled to a whole number; null when b is 0."""
    whole = f"cast({b} as hugeint)"
    return f"((2 * cast({a} as hugeint) * {10 ** digits} + {whole}) // (2 * nullif({whole}, 0)))"


def strict_rate(a: str, b: str, first_digits: int = 6) -> str:
    """Ratio rounded to ``first_digits`` and then to four decimals, as decimal(10,4)."""
    step = 10 ** (first_digits - 4)
    first = rounded_ratio(a, b, first_digits)
    return f"cast(cast(({first} + {step // 2}) // {step} as double) / 10000 as decimal(10,4))"


def lenient_rate(a: str, b: str, digits: int = 4) -> str:
    """Ratio rounded to four decimals as a double; null unless b is positive."""
    return f"case when ({b}) > 0 then cast({rounded_ratio(a, b, digits)} as double) / {10 ** digits} end"


def average8(sum_cents: str, n: str) -> str:
    return f"cast(cast({rounded_ratio(sum_cents, n, 6)} as double) / 100000000 as decimal(18,8))"


def money(amount: str) -> str:
    return f"cast(coalesce({amount}, 0) as decimal(22,2))"


def units(count: str) -> str:
    return f"cast(coalesce({count}, 0) as decimal(20,0))"


STRICT = f"""
sold as (
    select *, cast(unit_price * quantity as decimal(12,2)) as gross_sale_amount,
        cast(sale_amount as decimal(12,2)) as net_sale_amount,
        {strict_rate(cents("discount_amount"), cents("unit_price * quantity"), 8)} as discount_rate
    from sales
),
back as (
    select r.*, s.sale_date, s.sale_date is not null as has_sale,
        cast(r.return_date - s.sale_date as int) as days_until_return,
        coalesce(r.return_date - s.sale_date > 30, false) as late_return_flag,
        not r.receipt_present as no_receipt_flag,
        r.item_condition in ('damaged', 'defective') or r.return_reason in ('damaged', 'defective')
            as damaged_or_defective_flag,
        r.return_amount >= 200 as high_value_return_flag
    from returns r left join sales s on r.sale_id = s.sale_id
),
back_wide as (
    select back.*, p.product_name, p.product_category, p.product_subcategory, p.brand, st.store_name,
        st.city as store_city, st.province as store_province, st.region as store_region, st.store_type,
        c.loyalty_tier as customer_loyalty_tier, e.role as employee_role
    from back left join products p on back.product_id = p.product_id
        left join stores st on back.store_id = st.store_id
        left join customers c on back.customer_id = c.customer_id
        left join employees e on back.employee_id = e.employee_id
),
back_by_sale as (
    select sale_id, transaction_id, product_id, store_id, customer_id, count(*) as n,
        sum(return_quantity) as qty, sum(return_amount) as amount, min(return_date) as first_day,
        max(return_date) as last_day, bool_or(late_return_flag) as late, bool_or(no_receipt_flag) as bare,
        bool_or(damaged_or_defective_flag) as broken, bool_or(high_value_return_flag) as high,
        bool_or(policy_exception_flag) as policy
    from back group by all
),
matched as (
    select s.*, coalesce(b.n, 0) as n, coalesce(b.qty, 0) as qty, coalesce(b.amount, 0) as amount,
        b.first_day, b.last_day, coalesce(b.late, false) as late, coalesce(b.bare, false) as bare,
        coalesce(b.broken, false) as broken, coalesce(b.high, false) as high,
        coalesce(b.policy, false) as policy
    from sold s left join back_by_sale b on b.sale_id = s.sale_id and b.transaction_id = s.transaction_id
        and b.product_id = s.product_id and b.store_id = s.store_id and b.customer_id = s.customer_id
),
mart_daily as (
    select calendar_date, cast(sum(sold_n) as bigint) as total_sales, {money("sum(sold_amount)")} as total_sales_amount,
        cast(sum(back_n) as bigint) as total_returns, {money("sum(back_amount)")} as total_return_amount,
        coalesce({strict_rate("sum(back_n)", "sum(sold_n)")}, 0) as return_rate,
        cast(coalesce(sum(sold_amount), 0) - coalesce(sum(back_amount), 0) as decimal(22,2))
            as net_revenue_after_returns
    from (
        select sale_date as calendar_date, 1 as sold_n, sale_amount as sold_amount, 0 as back_n, null as back_amount
        from sold
        union all
        select return_date, 0, null, 1, return_amount from back
    ) group by calendar_date
),
mart_product as (
    select p.product_id, p.product_name, p.product_category, p.product_subcategory, p.brand,
        {units("t.sold_units")} as total_units_sold, {money("t.sold_amount")} as total_sales_amount,
        {units("t.back_units")} as total_units_returned, {money("t.back_amount")} as total_return_amount,
        coalesce({strict_rate("t.back_units", "t.sold_units")}, 0) as return_rate,
        coalesce(t.sold_units >= 10 and {rounded_ratio("t.back_units", "t.sold_units", 6)} >= 200000, false)
            as high_return_product_flag,
        w.return_reason as top_return_reason
    from products p
    left join (
        select product_id, sum(quantity) as sold_units, sum(net_sale_amount) as sold_amount,
            sum(qty) as back_units, sum(amount) as back_amount
        from matched group by product_id
    ) t on t.product_id = p.product_id
    left join (
        select product_id, return_reason from back group by product_id, return_reason
        qualify row_number() over (
            partition by product_id order by count(*) desc, sum(return_amount) desc, return_reason
        ) = 1
    ) w on w.product_id = p.product_id
),
mart_store as (
    select st.store_id, st.store_name, st.city as store_city, st.province as store_province,
        st.region as store_region, st.store_type, coalesce(s.n, 0) as total_sales,
        {money("s.amount")} as total_sales_amount, coalesce(b.n, 0) as total_returns,
        {money("b.amount")} as total_return_amount,
        coalesce({strict_rate("coalesce(b.n, 0)", "s.n")}, 0) as return_rate,
        coalesce({strict_rate("b.bare", "b.n")}, 0) as no_receipt_return_rate,
        coalesce({strict_rate("b.policy", "b.n")}, 0) as policy_exception_rate
    from stores st
    left join (select store_id, count(*) as n, sum(net_sale_amount) as amount from sold group by 1) s
        on s.store_id = st.store_id
    left join (
        select store_id, count(*) as n, sum(return_amount) as amount,
            count(*) filter (no_receipt_flag) as bare, count(*) filter (policy_exception_flag) as policy
        from back group by 1
    ) b on b.store_id = st.store_id
),
mart_reason as (
    select return_reason, n as total_returns, {money("amount")} as total_return_amount,
        coalesce({strict_rate("n", "(select count(*) from back)")}, 0) as percent_of_returns,
        {average8(cents("amount"), "n")} as average_return_amount
    from (select return_reason, count(*) as n, sum(return_amount) as amount from back group by 1)
),
mart_exceptions as (
    select return_id, sale_id, transaction_id, sale_date, return_date, store_id, store_name, store_city,
        store_region, customer_id, customer_loyalty_tier, employee_id, employee_role, product_id,
        product_name, product_category, product_subcategory, return_quantity, return_amount,
        return_reason, return_channel, refund_method, receipt_present, item_condition,
        days_until_return, late_return_flag, no_receipt_flag, damaged_or_defective_flag,
        high_value_return_flag, policy_exception_flag,
        case when late_return_flag or no_receipt_flag or damaged_or_defective_flag or high_value_return_flag
            then concat_ws(', ', case when late_return_flag then 'late_return' end,
                case when no_receipt_flag then 'no_receipt' end,
                case when damaged_or_defective_flag then 'damaged_or_defective' end,
                case when high_value_return_flag then 'high_value_return' end)
            else 'source_policy_exception' end as exception_reason
    from back_wide
    where late_return_flag or no_receipt_flag or damaged_or_defective_flag or high_value_return_flag
        or policy_exception_flag
),
handled as (
    select e.employee_id, e.store_id, e.role as employee_role, e.hire_date, e.active_flag,
        coalesce(b.n, 0) as n, b.amount, coalesce(b.bare, 0) as bare, coalesce(b.policy, 0) as policy
    from employees e left join (
        select employee_id, count(*) as n, sum(return_amount) as amount, count(*) filter (no_receipt_flag) as bare,
            count(*) filter (policy_exception_flag) as policy
        from back group by 1
    ) b on b.employee_id = e.employee_id
),
mart_employee as (
    select employee_id, store_id, employee_role, hire_date, active_flag, n as total_returns_processed,
        {money("amount")} as total_return_amount_processed, bare as no_receipt_returns_processed,
        policy as policy_exception_returns_processed,
        coalesce({average8(cents("amount"), "n")}, 0) as average_return_amount,
        n >= 5 and n * 1000000 >= 2 * (select {rounded_ratio("sum(n)", "count(*)", 6)} from handled)
            as unusual_return_activity_flag
    from handled
)"""


def _entity(key: str, dimension: str, sale_names: str, return_names: str, sale_key: str = "", return_key: str = "") -> str:
    """Gold mart as a full join of a dimension with aggregated sales and returns."""
    sale = {
        "sale_count": "count(distinct sale_id)", "units_sold": "sum(quantity)",
        "gross_sales_amount": "sum(gross)", "net_sales_amount": "sum(net)", "recorded_sales_amount": "sum(sale_amount)",
    }
    ret = {
        "return_count": "count(distinct return_id)", "units_returned": "sum(return_quantity)",
        "return_amount": "sum(return_amount)", "late_return_count": "count(*) filter (late_return_flag)",
        "no_receipt_return_count": "count(*) filter (no_receipt_flag)",
        "damaged_or_defective_return_count": "count(*) filter (damaged_or_defective_flag)",
        "policy_exception_count": "count(*) filter (cleaned_policy_exception_flag)",
        "high_value_return_count": "count(*) filter (high_value_return_flag)",
    }
    s, r = sale_names.split(), return_names.split()
    sales_sql = ", ".join(f"{sale[n]} as {n}" for n in s)
    returns_sql = ", ".join(f"{ret[n]} as {n}" for n in r)

    def out(name: str) -> str:
        kind = "double" if name.endswith("amount") else "bigint"
        return f"cast(coalesce({name}, 0) as {kind}) as {name}"

    z = lambda name: f"coalesce({name}, 0)"
    head = f"select * from {dimension}" if dimension else f"select null as {key} where false"
    attributes = f"d.* exclude ({key})," if dimension else ""
    return f"""
    select coalesce(d.{key}, s.{key}, r.{key}) as {key}, {attributes}
        {", ".join(out(n) for n in s + r)},
        {lenient_rate(z("units_returned"), z("units_sold"))} as return_rate_by_units,
        {lenient_rate(cents(z("return_amount")), cents(z("net_sales_amount")))} as return_rate_by_amount
    from ({head}) d
    full join (select {sale_key or key} as {key}, {sales_sql} from silver_sold group by 1) s on s.{key} = d.{key}
    full join (select {return_key or key} as {key}, {returns_sql} from silver_back group by 1) r
        on r.{key} = coalesce(d.{key}, s.{key})"""


LENIENT = f"""
silver_products as (
    select lower(product_id) as product_id, lower(product_name) as product_name, product_category,
        lower(product_subcategory) as product_subcategory, lower(brand) as brand,
        cast(unit_price as double) as unit_price, cast(cost as double) as cost, active_flag from products
),
silver_stores as (
    select lower(store_id) as store_id, lower(store_name) as store_name, lower(city) as city,
        lower(province) as province, lower(region) as region, store_type, open_date from stores
),
silver_customers as (
    select lower(customer_id) as customer_id, loyalty_tier, signup_date, lower(city) as city,
        lower(province) as province from customers
),
silver_employees as (
    select lower(employee_id) as employee_id, lower(store_id) as store_id, role, hire_date, active_flag from employees
),
silver_sold as (
    select lower(sale_id) as sale_id, lower(transaction_id) as transaction_id, sale_date,
        lower(store_id) as store_id, lower(customer_id) as customer_id, lower(employee_id) as employee_id,
        lower(product_id) as product_id, quantity, unit_price, discount_amount, sale_amount, payment_method,
        sales_channel, unit_price * quantity as gross, unit_price * quantity - discount_amount as net
    from sales
),
silver_back as (
    select lower(r.return_id) as return_id, lower(r.sale_id) as sale_id, lower(r.transaction_id) as transaction_id,
        r.return_date, lower(r.store_id) as store_id, lower(r.customer_id) as customer_id,
        lower(r.employee_id) as employee_id, lower(r.product_id) as product_id, r.return_quantity,
        r.return_amount, r.return_reason, r.return_channel, r.refund_method, r.receipt_present,
        r.item_condition, r.policy_exception_flag as cleaned_policy_exception_flag, s.sale_date,
        cast(r.return_date - s.sale_date as int) as days_until_return,
        r.return_date - s.sale_date > 30 as late_return_flag, not r.receipt_present as no_receipt_flag,
        r.item_condition in ('damaged', 'defective') or r.return_reason like '%damaged%'
            or r.return_reason like '%defective%' as damaged_or_defective_flag,
        r.return_amount >= 100 as high_value_return_flag
    from returns r left join sales s on r.sale_id = s.sale_id
),
gold_daily as ({_entity(
    "activity_date", "",
    "sale_count units_sold gross_sales_amount net_sales_amount recorded_sales_amount",
    "return_count units_returned return_amount late_return_count no_receipt_return_count high_value_return_count",
    "sale_date", "return_date")}
),
gold_product as ({_entity(
    "product_id", "silver_products", "sale_count units_sold gross_sales_amount net_sales_amount",
    "return_count units_returned return_amount damaged_or_defective_return_count high_value_return_count")}
),
gold_store as ({_entity(
    "store_id", "silver_stores", "sale_count units_sold net_sales_amount",
    "return_count units_returned return_amount late_return_count no_receipt_return_count policy_exception_count")}
),
gold_employee as ({_entity(
    "employee_id", "silver_employees", "sale_count units_sold net_sales_amount",
    "return_count units_returned return_amount late_return_count no_receipt_return_count"
    " policy_exception_count high_value_return_count")}
),
gold_reason as (
    select coalesce(return_reason, 'unknown') as return_reason, count(distinct return_id) as return_count,
        cast(sum(return_quantity) as bigint) as units_returned, cast(sum(return_amount) as double) as return_amount,
        cast({rounded_ratio("sum(days_until_return)", "count(days_until_return)", 2)} as double) / 100
            as avg_days_until_return,
        count(*) filter (late_return_flag) as late_return_count,
        count(*) filter (no_receipt_flag) as no_receipt_return_count,
        count(*) filter (damaged_or_defective_flag) as damaged_or_defective_return_count,
        count(*) filter (cleaned_policy_exception_flag) as policy_exception_count,
        count(*) filter (high_value_return_flag) as high_value_return_count
    from silver_back group by 1
),
gold_policy as (
    select b.* replace (cast(return_quantity as int) as return_quantity, cast(return_amount as double) as return_amount),
        p.product_name, p.product_category, p.product_subcategory, p.brand, st.store_name, st.city,
        st.province, st.region, st.store_type, e.role as employee_role, e.active_flag as employee_active_flag
    from silver_back b left join silver_products p on p.product_id = b.product_id
        left join silver_stores st on st.store_id = b.store_id
        left join silver_employees e on e.employee_id = b.employee_id
    where cleaned_policy_exception_flag
)"""


def derived(body: str, *more: str) -> str:
    return "with " + ",".join([DERIVED, *more]) + "\n" + body.strip()


def strict(body: str) -> str:
    return derived(body, STRICT)


def lenient(body: str) -> str:
    return derived(body, LENIENT)
