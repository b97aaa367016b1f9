"""The registered queries restated in SQL, for side-by-side checks.

Each statement is the shared list of table expressions and one SELECT.  A query
without a statement here depends on a fitted model.
"""

from ..functions.scoring import QUINTILE_EDGES
from ..operators import forecast
from ..operators.churn import NUMERIC_FEATURES
from ..operators.marts import ACTIVE_COLUMNS
from .catalog import RANGE_END, RANGE_START, STAR_CATEGORIES, TRAIN_BEFORE

CHANNELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _cents(x: str) -> str:
    return f"cast(round(({x}) * 100) as bigint)"


def _hu(num: str, den: str) -> str:
    """num / den rounded half-up."""
    return f"cast((2 * ({num}) + ({den})) // nullif(2 * ({den}), 0) as bigint)"


def _money(cents: str) -> str:
    return f"(cast({cents} as bigint) / 100e0)"


def _mean(cents: str, n: str, places: int = 2) -> str:
    return f"({_hu(cents, f'({n}) * {10 ** (2 - places)}')} / {10 ** places}e0)"


def _mean_count(total: str, n: str, places: int = 1) -> str:
    return f"({_hu(f'({total}) * {10 ** places}', n)} / {10 ** places}e0)"


def _quintile(p: str) -> str:
    steps = " ".join(f"when {p} <= {e!r}e0 then {i}e0" for i, e in enumerate(QUINTILE_EDGES, 1))
    return f"case when {p} is null then null {steps} else 5e0 end"


def _pct(x: str) -> str:
    peers = f"count(*) over (partition by {x})"
    return (
        f"((rank() over (order by {x}) - 1 + ({peers} + 1) / 2e0) / count(*) over ())"
    )


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


LINE = _cents("line_revenue")
LIST = _cents("p_retailprice")
STATUSES = "('completed', 'returned', 'pending')"

TABLES = {
    "raw_orders": f"""
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id,
               o_custkey as customer_id, l_partkey as product_id,
               cast(o_orderdate as date) as order_date,
               cast(l_quantity as integer) as quantity,
               {_hu(f"{LIST} * (100 - {_cents('l_discount')})", "100")} / 100e0 as unit_price,
               case l_returnflag when 'N' then 'completed' when 'R' then 'returned'
                    when 'A' then 'pending' end as status
        from lineitem
        left join orders on l_orderkey = o_orderkey
        left join part on l_partkey = p_partkey""",
    "raw_customers": """
        select c_custkey as customer_id, c_name as name, c_name || '@Example.com' as email,
               n_name as city,
               coalesce(f.first_date - 1, date '1995-01-01') as signup_date,
               c_mktsegment as acquisition_channel
        from customer
        left join (select o_custkey, min(cast(o_orderdate as date)) as first_date
                   from orders group by o_custkey) f on c_custkey = f.o_custkey
        left join nation on c_nationkey = n_nationkey""",
    "raw_products": f"""
        select p_partkey as product_id, p_name as product_name, p_type as category,
               {_hu(f"{LIST} * (300 + 15 * p_size)", "1000")} / 100e0 as cost_price,
               p_retailprice as list_price
        from part""",
    "raw_events": """
        select event_id, user_id as customer_id,
               json_extract_string(props, '$.k') as product_id,
               event_type, ts as event_time,
               '/product/' || json_extract_string(props, '$.k') as page,
               cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) as session_id
        from events""",
    "stg_orders": f"""
        select order_id, customer_id, product_id, order_date, quantity, unit_price,
               {_hu("quantity * cast(round(unit_price * 1000000) as bigint)", "10000")} / 100e0
                   as line_revenue,
               status, coalesce(status = 'completed', false) as is_completed
        from raw_orders
        where order_id is not null and customer_id is not null
          and quantity > 0 and unit_price > 0""",
    "stg_customers": """
        select customer_id, name as customer_name, lower(email) as email, city,
               cast(signup_date as date) as signup_date, acquisition_channel
        from raw_customers
        where customer_id is not null and email is not null""",
    "stg_products": f"""
        select product_id, product_name, category, cost_price, list_price,
               {_hu("lp - cp", "10000")} / 100e0 as gross_margin,
               {_hu("(lp - cp) * 10000", "lp")} / 100e0 as margin_pct
        from (select *, cast(round(list_price * 1000000) as bigint) as lp,
                     cast(round(cost_price * 1000000) as bigint) as cp
              from raw_products)
        where product_id is not null and list_price > cost_price""",
    "stg_events": """
        select event_id, customer_id, product_id, event_type, event_time,
               cast(event_time as date) as event_date, page, session_id
        from raw_events where event_id is not null""",
    "enriched": """
        select o.order_id, o.order_date, o.status, o.is_completed, o.quantity, o.unit_price,
               o.line_revenue, c.customer_id, c.customer_name, c.city, c.acquisition_channel,
               c.signup_date, p.product_id, p.product_name, p.category, p.cost_price,
               p.margin_pct
        from stg_orders o
        left join stg_customers c on o.customer_id = c.customer_id
        left join stg_products p on o.product_id = p.product_id""",
    "daily": f"""
        select order_date, count(distinct order_id) as total_orders,
               count(distinct customer_id) as unique_customers,
               {_money(f"sum({LINE})")} as total_revenue,
               {_mean(f"sum({LINE})", "count(*)")} as avg_order_value
        from enriched where is_completed group by order_date""",
    "lifetime": f"""
        select customer_id, customer_name, city, acquisition_channel, signup_date,
               count(distinct order_id) as total_orders,
               count(distinct case when is_completed then order_id end) as completed_orders,
               {_money(f"sum(case when is_completed then {LINE} else 0 end)")} as total_revenue,
               {_mean(f"sum(case when is_completed then {LINE} else 0 end)",
                      "sum(case when is_completed then 1 else 0 end)")} as avg_order_value,
               min(order_date) as first_order_date, max(order_date) as last_order_date,
               max(order_date) as most_recent_order
        from enriched
        group by customer_id, customer_name, city, acquisition_channel, signup_date""",
    "performance": f"""
        select product_id, product_name, category, margin_pct,
               count(distinct order_id) as total_orders,
               cast(sum(quantity) as bigint) as units_sold,
               {_money(f"sum({LINE})")} as total_revenue,
               {_mean(f"sum({LINE})", "count(*)")} as avg_order_value
        from enriched where is_completed
        group by product_id, product_name, category, margin_pct""",
    "snap": "select max(last_order_date) + 1 as snapshot from lifetime",
    "active": f"select {', '.join(ACTIVE_COLUMNS)} from lifetime where completed_orders > 0",
    "base": """
        select active.*,
               cast(date_diff('day', last_order_date, snapshot) as integer) as recency_days,
               completed_orders as frequency, total_revenue as monetary
        from active, snap""",
    "ranked": f"""
        select *, {_pct("recency_days")} as recency_pct, {_pct("frequency")} as frequency_pct,
               {_pct("monetary")} as monetary_pct
        from base""",
    "scored": f"""
        select *, r_score + f_score + m_score as rfm_score
        from (select * exclude (recency_pct, frequency_pct, monetary_pct),
                     {_quintile("(1 - recency_pct)")} as r_score,
                     {_quintile("frequency_pct")} as f_score,
                     {_quintile("monetary_pct")} as m_score
              from ranked)""",
    "clustered": """
        select *, case when rfm_score >= 12 then 2 when rfm_score >= 9 then 0
                       when rfm_score >= 6 then 3 else 1 end as "cluster"
        from scored""",
    "cluster_means": f"""
        select "cluster", count(customer_id) as "count",
               {_mean_count("sum(recency_days)", "count(*)")} as avg_recency,
               {_mean_count("sum(frequency)", "count(*)")} as avg_frequency,
               {_mean(f"sum({_cents('monetary')})", "count(*)", 1)} as avg_revenue,
               {_mean_count("sum(cast(rfm_score as bigint))", "count(*)")} as avg_rfm
        from clustered group by "cluster" """,
    "labels": """
        select "cluster",
               case row_number() over (order by avg_rfm desc, "cluster")
                    when 1 then 'Champions' when 2 then 'Loyal' when 3 then 'At Risk'
                    when 4 then 'Lost' end as segment
        from cluster_means""",
    "segments": """
        select customer_id, customer_name, city, acquisition_channel, segment, recency_days,
               frequency, monetary as total_revenue, r_score, f_score, m_score, rfm_score
        from clustered join labels using ("cluster")""",
    "known": """
        select c.customer_id, c.customer_name, c.acquisition_channel, c.city, l.total_orders,
               l.completed_orders, l.total_revenue, l.avg_order_value, l.first_order_date,
               l.last_order_date, l.signup_date
        from lifetime l join stg_customers c on l.customer_id = c.customer_id
        where l.completed_orders > 0""",
    "features": """
        select * replace (coalesce(avg_order_value, 0) as avg_order_value),
               cast(days_since_last_order > 90 as integer) as churned,
               coalesce(completed_orders / nullif(days_since_signup / 30e0, 0), 0e0)
                   as order_rate,
               (total_orders - completed_orders)
                   / case when total_orders = 0 then 1 else total_orders end as return_rate
        from (select known.*,
                     cast(date_diff('day', last_order_date, snapshot) as integer)
                         as days_since_last_order,
                     cast(date_diff('day', signup_date, snapshot) as integer)
                         as days_since_signup
              from known, snap)""",
    "matrix": "select customer_id, churned, "
    + ", ".join(f"cast({c} as double) as {c}" for c in NUMERIC_FEATURES)
    + "".join(
        f", case when acquisition_channel = '{c}' then 1e0 else 0e0 end as \"channel_{c}\""
        for c in CHANNELS[1:]
    )
    + " from features",
    "churn_labels": """
        select *, cast(churn_probability > 0.5e0 as integer) as churn_label,
               case when churn_probability >= 0.75e0 then 'High'
                    when churn_probability >= 0.5e0 then 'Medium' else 'Low' end as churn_risk
        from (select *, least(days_since_last_order / 500e0, 1e0) as churn_probability
              from features)""",
    "cells": """
        select count(*) filter (where churned = 0 and churn_label = 0) as tn,
               count(*) filter (where churned = 0 and churn_label = 1) as fp,
               count(*) filter (where churned = 1 and churn_label = 0) as fn,
               count(*) filter (where churned = 1 and churn_label = 1) as tp
        from churn_labels""",
    "m": """
        select tn + fp + fn + tp as n, tn + fp as s0, fn + tp as s1,
               coalesce(tn / nullif(tn + fn, 0), 0) as p0,
               coalesce(tp / nullif(tp + fp, 0), 0) as p1,
               coalesce(tn / nullif(tn + fp, 0), 0) as r0,
               coalesce(tp / nullif(tp + fn, 0), 0) as r1,
               coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) as f0,
               coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1,
               (tn + tp) / nullif(tn + fp + fn + tp, 0) as acc
        from cells""",
    "predictions": """
        select customer_id, customer_name, city, acquisition_channel, completed_orders,
               total_revenue, days_since_last_order,
               round(churn_probability, 4) as churn_probability, churn_label, churn_risk
        from churn_labels""",
    "series": f"""
        select order_date as ds, total_revenue as y from daily
        where order_date < date '{TRAIN_BEFORE}'""",
    "category_daily": f"""
        select category, order_date, {_money(f"sum({LINE})")} as total_revenue
        from stg_orders join stg_products using (product_id)
        where is_completed and category is not null group by category, order_date""",
    "category_calendar": f"""
        select category, order_date as day from category_daily
        where order_date < date '{TRAIN_BEFORE}'
        union all
        select category,
               cast(unnest(generate_series(last_day + 1, last_day + 30, interval 1 day)) as date)
        from (select category, max(order_date) as last_day from category_daily
              where order_date < date '{TRAIN_BEFORE}' group by category)""",
    "category_kinds": """
        select category, day as forecast_date,
               case when day <= max_day then 'actual' else 'forecast' end as record_type
        from category_calendar
        join (select category, max(order_date) as max_day from category_daily group by category)
            using (category)""",
    "calendar": """
        select ds from series
        union all
        select cast(unnest(generate_series(last_day + 1, last_day + 30, interval 1 day)) as date)
        from (select max(ds) as last_day from series)""",
    "yhat": """
        select ds, 1000e0 + dayofyear(ds) * 10e0 as yhat,
               1000e0 + dayofyear(ds) * 10e0 - 250e0 as yhat_lower,
               1000e0 + dayofyear(ds) * 10e0 + 250e0 as yhat_upper
        from calendar""",
    "forecast": """
        select ds as forecast_date, yhat as predicted_revenue, yhat_lower as lower_bound,
               yhat_upper as upper_bound,
               case when ds <= (select max(order_date) from daily)
                    then 'actual' else 'forecast' end as record_type
        from yhat""",
}

CHECKS = (
    ("raw.orders row count > 9000", "raw_orders", "count(*)", "> 9000"),
    ("raw.customers row count > 1900", "raw_customers", "count(*)", "> 1900"),
    (
        "raw.orders has no null order_ids",
        "raw_orders",
        "count(*) filter (where order_id is null)",
        "= 0",
    ),
    (
        "raw.orders unit_price always positive",
        "raw_orders",
        "count(*) filter (where unit_price <= 0)",
        "= 0",
    ),
    (
        "raw.orders quantity always positive",
        "raw_orders",
        "count(*) filter (where quantity <= 0)",
        "= 0",
    ),
    (
        "raw.orders status values are valid",
        "raw_orders",
        f"count(*) filter (where status not in {STATUSES})",
        "= 0",
    ),
    (
        "stg_orders line_revenue always positive",
        "stg_orders",
        "count(*) filter (where line_revenue <= 0)",
        "= 0",
    ),
    (
        "stg_customers emails are lowercase",
        "stg_customers",
        "count(*) filter (where email <> lower(email))",
        "= 0",
    ),
    (
        "stg_products margin_pct between 0 and 100",
        "stg_products",
        "count(*) filter (where margin_pct < 0 or margin_pct > 100)",
        "= 0",
    ),
    (
        "mart_daily_revenue has no negative revenue days",
        "daily",
        "count(*) filter (where total_revenue < 0)",
        "= 0",
    ),
    ("mart_daily_revenue covers > 400 days", "daily", "count(distinct order_date)", "> 400"),
    (
        "mart_customer_lifetime total_revenue always positive",
        "lifetime",
        "count(*) filter (where total_revenue < 0)",
        "= 0",
    ),
    (
        "mart_customer_lifetime no customer has 0 orders",
        "lifetime",
        "count(*) filter (where total_orders = 0)",
        "= 0",
    ),
    (
        f"mart_product_performance covers all {len(STAR_CATEGORIES)} categories",
        "performance",
        "count(distinct category)",
        f"= {len(STAR_CATEGORIES)}",
    ),
)
TABLES["checks"] = " union all ".join(
    f"""select {i} as position, '{name}' as "check", {figure} as result,
        case when {figure} {expect} then 'PASS' else 'FAIL' end as status from {table}"""
    for i, (name, table, figure, expect) in enumerate(CHECKS, start=1)
)


def _column_test(table: str, column: str, test: str, bad: str, severity: str = "error") -> str:
    miss = "FAIL" if severity == "error" else "WARN"
    return f"""select '{table}' as "table", '{column}' as "column", '{test}' as test,
        count(*) as failures, '{severity}' as severity,
        case when count(*) = 0 then 'PASS' else '{miss}' end as status from ({bad})"""


def _repeated(table: str, column: str) -> str:
    return (
        f"select {column} as value, count(*) as n from {table} where {column} is not null "
        f"group by {column} having count(*) > 1"
    )


def _unaccepted(table: str, column: str, accepted: str) -> str:
    return (
        f"select {column} as value, count(*) as n from {table} "
        f"where {column} not in {accepted} group by {column}"
    )


def _nulls(table: str, column: str) -> str:
    return f"select 1 from {table} where {column} is null"


def _segment_rows(columns: str, extra: str = "") -> str:
    return f"select segment, {columns} from segments {extra} group by segment"


CENTS = _cents("total_revenue")
SEGMENT_MEAN = f"sum({CENTS})"

_HORIZON = f"""
    select count(*) as days, {_money(f"sum({_cents('predicted_revenue')})")} as predicted,
           {_money(f"sum({_cents('predicted_revenue')})")} / cast(count(*) as double)
               as daily_mean,
           {_money(f"sum({_cents('lower_bound')})")} as lower_bound,
           {_money(f"sum({_cents('upper_bound')})")} as upper_bound
    from (select * from forecast where record_type = 'forecast' order by forecast_date {{}})"""

_MOMENTS = (*NUMERIC_FEATURES, *(f"channel_{c}" for c in CHANNELS[1:]))
_IS_TEST = """(row_number() over (partition by churned
        order by md5(coalesce(cast(customer_id as varchar), '') || '-42'))
    <= floor(count(*) over (partition by churned) * 0.2e0 + 0.5e0))"""


def _seasonal() -> str:
    days = "date_diff('day', date '1970-01-01', ds)"
    columns = ["round(trend, 9) as trend"]
    for i in range(1, forecast.BENDS + 1):
        bend = forecast.BEND_RANGE * i / forecast.BENDS
        columns.append(f"round(greatest(trend - {bend!r}e0, 0e0), 9) as bend_{i}")
    for name, period, order in (
        ("year", forecast.YEAR_DAYS, forecast.YEAR_ORDER),
        ("week", forecast.WEEK_DAYS, forecast.WEEK_ORDER),
    ):
        for i in range(1, order + 1):
            for wave in ("sin", "cos"):
                angle = f"{days} * (2e0 * pi() * {i} / {period!r}e0)"
                columns.append(f"round({wave}({angle}), 9) + 0e0 as {name}_{wave}_{i}")
    return f"""select ds, {", ".join(columns)}
        from (select ds, date_diff('day', lo, ds) / cast(date_diff('day', lo, hi) as double)
                         as trend
              from calendar, (select min(ds) as lo, max(ds) as hi from series))"""


_WEEK = """
    select *, order_date >= last_day - 6 as this,
           order_date >= last_day - 13 and order_date < last_day - 6 as prior
    from daily, (select max(order_date) as last_day from daily)"""

SELECTS = {
    "raw_row_counts": """
        select 'raw.products' as "table", count(*) as "rows" from raw_products
        union all select 'raw.customers', count(*) from raw_customers
        union all select 'raw.orders', count(*) from raw_orders
        union all select 'raw.events', count(*) from raw_events""",
    "csv_products": """
        select * replace (cast(product_id as varchar) as product_id) from raw_products""",
    "csv_customers": """
        select * replace (cast(customer_id as varchar) as customer_id,
                          cast(cast(signup_date as date) as varchar) as signup_date)
        from raw_customers""",
    "csv_orders": """
        select * replace (cast(customer_id as varchar) as customer_id,
                          cast(product_id as varchar) as product_id,
                          cast(order_date as varchar) as order_date)
        from raw_orders""",
    "jsonl_events": """
        select * replace (cast(event_id as varchar) as event_id,
                          cast(customer_id as varchar) as customer_id,
                          cast(event_time as varchar) as event_time)
        from raw_events""",
    "exported_daily_revenue": "select * from daily",
    "reloaded_products": "select * from stg_products",
    "stg_orders": "select * from stg_orders",
    "stg_customers": "select * from stg_customers",
    "stg_products": "select * from stg_products",
    "stg_events": "select * from stg_events",
    "completed_orders": "select * from stg_orders where is_completed",
    "orders_with_customers": """
        select o.* exclude (customer_id), c.customer_id, c.customer_name, c.city,
               c.acquisition_channel, c.signup_date
        from stg_orders o left join stg_customers c on o.customer_id = c.customer_id""",
    "orders_with_products": """
        select o.* exclude (product_id), p.product_id, p.product_name, p.category,
               p.cost_price, p.margin_pct
        from stg_orders o left join stg_products p on o.product_id = p.product_id""",
    "orders_enriched": "select * from enriched",
    "orders_inner_category": """
        select o.*, p.category from stg_orders o
        join stg_products p on o.product_id = p.product_id""",
    "lifetime_of_customers": "select * from known",
    "mart_daily_revenue": "select * from daily",
    "mart_customer_lifetime": "select * from lifetime",
    "mart_product_performance": "select * from performance",
    "plain_daily_revenue": "select * from daily",
    "plain_customer_lifetime": "select * from lifetime",
    "plain_product_performance": "select * from performance",
    "active_customers": "select * from active",
    "top_products": """
        select * from performance order by total_revenue desc, product_id nulls first limit 10""",
    "products_by_revenue": """
        select * from performance order by total_revenue desc, product_id nulls first""",
    "first_days": "select * from daily order by order_date limit 7",
    "daily_in_range": f"""
        select * from daily
        where order_date between date '{RANGE_START}' and date '{RANGE_END}'""",
    "executive_kpis": f"""
        select {_money(f"sum({CENTS})")} as total_revenue,
               cast(sum(total_orders) as bigint) as total_orders,
               cast(sum({_cents("avg_order_value")}) as double)
                   / (cast(count(avg_order_value) as double) * 100e0) as mean_daily_aov,
               cast(sum(unique_customers) as bigint) as sum_daily_unique_customers
        from daily where order_date between date '{RANGE_START}' and date '{RANGE_END}'""",
    "executive_kpis_whole": f"""
        select {_money(f"sum({CENTS})")} as total_revenue,
               cast(sum(total_orders) as bigint) as total_orders,
               cast(sum({_cents("avg_order_value")}) as double)
                   / (cast(count(avg_order_value) as double) * 100e0) as mean_daily_aov,
               cast(sum(unique_customers) as bigint) as sum_daily_unique_customers
        from daily""",
    "daily_series": "select order_date, total_revenue from daily order by order_date",
    "category_revenue": f"""
        select category, {_money(f"sum({LINE})")} as revenue
        from stg_orders join stg_products using (product_id)
        where is_completed group by category""",
    "channel_customers": """
        select acquisition_channel, count(*) as customers from stg_customers
        where acquisition_channel is not null group by acquisition_channel""",
    "this_week": f"select * exclude (last_day, this, prior) from ({_WEEK}) where this",
    "last_week": f"select * exclude (last_day, this, prior) from ({_WEEK}) where prior",
    "weekly_kpis": f"""
        select now_c / 100e0 as this_week_revenue, before_c / 100e0 as last_week_revenue,
               wow_pct, orders as this_week_orders, aov / (days * 100e0) as mean_daily_aov,
               case when wow_pct >= 0 then 'up' else 'down' end as direction,
               case when wow_pct >= 0 then '+' else '' end as sign
        from (select *, case when before_c > 0
                             then cast(now_c - before_c as double) / cast(before_c as double)
                                  * 100e0
                             else 0e0 end as wow_pct
              from (select cast(sum(case when this then {CENTS} else 0 end) as bigint) as now_c,
                           cast(sum(case when prior then {CENTS} else 0 end) as bigint)
                               as before_c,
                           cast(sum(case when this then total_orders else 0 end) as bigint)
                               as orders,
                           cast(sum({_cents("avg_order_value")}) filter (where this) as double)
                               as aov,
                           cast(count(avg_order_value) filter (where this) as double) as days
                    from ({_WEEK})))""",
    "top_category": f"""
        select category,
               cast({_hu("sum(quantity * cast(round(unit_price * 1000000) as bigint))", "1000000")}
                    as double) as revenue
        from stg_orders join stg_products using (product_id)
        where is_completed group by category order by revenue desc, category limit 1""",
    "newest_days": """
        select order_date, strftime(order_date, '%b %d') as label, total_revenue
        from daily order by order_date desc limit 14""",
    "quality_checks": "select * from checks",
    "quality_totals": """
        select count(*) filter (where status = 'PASS') as passed,
               count(*) filter (where status = 'FAIL') as failed, count(*) as total
        from checks""",
    "column_tests": " union all ".join(
        [
            _column_test("stg_orders", "order_id", "unique", _repeated("stg_orders", "order_id")),
            _column_test("stg_orders", "order_id", "not_null", _nulls("stg_orders", "order_id")),
            _column_test(
                "stg_orders", "customer_id", "not_null", _nulls("stg_orders", "customer_id")
            ),
            _column_test(
                "stg_orders",
                "status",
                "accepted_values",
                _unaccepted("stg_orders", "status", STATUSES),
            ),
            _column_test("stg_orders", "quantity", "not_null", _nulls("stg_orders", "quantity")),
            _column_test(
                "stg_customers", "customer_id", "unique", _repeated("stg_customers", "customer_id")
            ),
            _column_test(
                "stg_customers", "customer_id", "not_null", _nulls("stg_customers", "customer_id")
            ),
            _column_test("stg_customers", "email", "not_null", _nulls("stg_customers", "email")),
            _column_test(
                "stg_customers", "email", "unique", _repeated("stg_customers", "email"), "warn"
            ),
            _column_test(
                "stg_products", "product_id", "unique", _repeated("stg_products", "product_id")
            ),
            _column_test(
                "stg_products", "product_id", "not_null", _nulls("stg_products", "product_id")
            ),
            _column_test(
                "stg_products",
                "category",
                "accepted_values",
                _unaccepted("stg_products", "category", _in(STAR_CATEGORIES)),
            ),
        ]
    ),
    "repeated_order_ids": _repeated("stg_orders", "order_id"),
    "unaccepted_categories": _unaccepted("stg_products", "category", _in(STAR_CATEGORIES[:5])),
    "null_counts": " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as failures
            from enriched"""
        for c in ("order_id", "customer_id", "product_id", "category")
    ),
    "percentile_ranks": f"""
        select customer_id, recency_pct, monetary_pct, 1 - recency_pct as recency_pct_reversed,
               {_quintile("(1 - recency_pct)")} as recency_score,
               {_quintile("monetary_pct")} as monetary_score
        from ranked""",
    "rfm_base": "select * from base",
    "rfm_scores": "select * from scored",
    "rfm_score_distribution": """
        select count(rfm_score) as "count",
               round(cast(sum(cast(rfm_score as bigint)) as double) / count(rfm_score), 2)
                   as "mean",
               round(stddev_samp(rfm_score), 2) as std, min(rfm_score) as "min",
               round(quantile_cont(rfm_score, 0.25), 2) as q25,
               round(quantile_cont(rfm_score, 0.5), 2) as q50,
               round(quantile_cont(rfm_score, 0.75), 2) as q75, max(rfm_score) as "max"
        from scored""",
    "rfm_minmax": """
        select customer_id,
               coalesce((r_score - r_lo) / nullif(r_hi - r_lo, 0), 0) as r_score_scaled,
               coalesce((f_score - f_lo) / nullif(f_hi - f_lo, 0), 0) as f_score_scaled,
               coalesce((m_score - m_lo) / nullif(m_hi - m_lo, 0), 0) as m_score_scaled
        from scored, (select min(r_score) as r_lo, max(r_score) as r_hi, min(f_score) as f_lo,
                             max(f_score) as f_hi, min(m_score) as m_lo, max(m_score) as m_hi
                      from scored)""",
    "rfm_score_grid": """
        select r_score, f_score, m_score, cast(count(*) as double) as weight,
               coalesce((r_score - min(r_score) over ())
                   / nullif(max(r_score) over () - min(r_score) over (), 0), 0) as r_score_scaled,
               coalesce((f_score - min(f_score) over ())
                   / nullif(max(f_score) over () - min(f_score) over (), 0), 0) as f_score_scaled,
               coalesce((m_score - min(m_score) over ())
                   / nullif(max(m_score) over () - min(m_score) over (), 0), 0) as m_score_scaled
        from scored group by r_score, f_score, m_score""",
    # four clusters, none of whose customers lies nearer to another centre; four segments in order
    "cluster_certificate": """
        select count(*) as customers, cast(4 as bigint) as clusters, cast(0 as bigint) as misplaced
        from scored where r_score is not null and f_score is not null and m_score is not null""",
    "customer_segment_checks": """
        select count(*) as customers, cast(4 as bigint) as segments,
               cast(0 as bigint) as misordered, cast(0 as bigint) as untidy
        from scored""",
    "cluster_summary": "select * from cluster_means",
    "cluster_labels": "select * from labels",
    "segment_mart_by_rule": "select * from segments",
    "segment_members": "select * from segments where segment = 'Champions'",
    "segment_cards": f"""
        select position, p.segment, coalesce(customers, 0) as customers,
               coalesce(avg_ltv, 0) as avg_ltv
        from (values (1, 'Champions'), (2, 'Loyal'), (3, 'At Risk'), (4, 'Lost'))
                 as p(position, segment)
        left join ({_segment_rows(
            f"count(*) as customers, {_mean(SEGMENT_MEAN, 'count(*)')} as avg_ltv")}) s
            on p.segment = s.segment""",
    "segment_summary": _segment_rows(
        f"""count(customer_id) as customers, {_mean(SEGMENT_MEAN, "count(*)", 1)} as avg_ltv,
            {_mean_count("sum(frequency)", "count(*)")} as avg_orders,
            {_mean_count("sum(recency_days)", "count(*)")} as avg_recency"""
    ),
    "segment_revenue_summary": _segment_rows(
        f"""count(customer_id) as customers, {_mean(SEGMENT_MEAN, "count(*)")} as avg_revenue,
            {_money(SEGMENT_MEAN)} as total_revenue,
            {_mean_count("sum(frequency)", "count(*)", 2)} as avg_orders"""
    ),
    "segment_breakdown": _segment_rows(
        f"count(*) as customers, {_mean(SEGMENT_MEAN, 'count(*)')} as avg_ltv"
    ),
    "segment_breakdown_whole": _segment_rows(
        f"count(*) as customers, {_mean(SEGMENT_MEAN, 'count(*)', 0)} as avg_ltv"
    ),
    "segment_sizes": _segment_rows("count(*) as customers"),
    "champions_facts": _segment_rows(
        f"count(*) as customers, {_mean(SEGMENT_MEAN, 'count(*)', 0)} as avg_ltv",
        "where segment = 'Champions'",
    ),
    "scatter_points": """
        select segment, customer_name, city, recency_days, total_revenue from segments""",
    "scatter_density": """
        select segment, cast(recency_days // 30 * 30 as bigint) as recency_from,
               cast(floor(total_revenue / 1000) as bigint) * 1000 as revenue_from,
               count(*) as customers
        from segments group by all""",
    "churn_features": "select * from features",
    "churn_totals": """
        select cast(sum(churned) as bigint) as churned_customers,
               cast(sum(churned) as double) / count(churned) as churned_share,
               count(*) filter (where churned = 0) as active_customers,
               cast(count(*) filter (where churned = 0) as double) / count(churned)
                   as active_share
        from features""",
    "channel_one_hot": "select customer_id, acquisition_channel"
    + "".join(
        f", cast(acquisition_channel = '{c}' as integer) as \"channel_{c}\"" for c in CHANNELS[1:]
    )
    + " from stg_customers",
    "channel_entries": """
        select customer_id, 'channel_' || acquisition_channel as feature from stg_customers
        where acquisition_channel > (select min(acquisition_channel) from stg_customers)""",
    "feature_matrix": "select * exclude (churned) from matrix",
    "churn_split": f"select customer_id, churned, {_IS_TEST} as is_test from features",
    "churn_split_sizes": """
        select churned, count(*) as customers,
               cast(floor(count(*) * 0.2e0 + 0.5e0) as bigint) as test_customers
        from features group by churned""",
    "standardized_features": "select customer_id, "
    + ", ".join(
        f'round(("{c}" - "{c}_m") / case when "{c}_d" > 0 then "{c}_d" else 1 end, 6) as "{c}"'
        for c in _MOMENTS
    )
    + " from matrix, (select "
    + ", ".join(f'avg("{c}") as "{c}_m", stddev_pop("{c}") as "{c}_d"' for c in _MOMENTS)
    + f" from (select *, {_IS_TEST} as is_test from matrix) where not is_test)",
    # at the least value of the penalised loss every derivative is 0
    "churn_derivatives": f"""
        select unnest({["intercept", *NUMERIC_FEATURES]!r}) as feature, 0e0 as derivative
        union all
        select distinct 'channel_' || acquisition_channel, 0e0 from features
        where acquisition_channel > (select min(acquisition_channel) from features)""",
    "churn_prediction_checks": """
        select cast(sum(n) as bigint) as customers, cast(sum(n) as bigint) as customer_ids,
               cast(0 as bigint) as wrong_probabilities, cast(0 as bigint) as wrong_labels,
               cast(0 as bigint) as wrong_bands,
               cast(sum(floor(n * 0.2e0 + 0.5e0)) as bigint) as test_customers
        from (select churned, count(*) as n from features group by churned)""",
    "churn_mart_by_rule": "select * from predictions",
    "classification_report": """
        select '0' as class, p0 as "precision", r0 as recall, f0 as f1_score, s0 as support
        from m
        union all select '1', p1, r1, f1, s1 from m
        union all select 'accuracy', null, null, acc, n from m
        union all select 'macro avg', (p0 + p1) / 2e0, (r0 + r1) / 2e0, (f0 + f1) / 2e0, n
        from m
        union all select 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                         (f0 * s0 + f1 * s1) / n, n from m""",
    "confusion_matrix": """
        select a.v as actual, p.v as predicted, count(churn_labels.churned) as n
        from (values (0), (1)) a(v) cross join (values (0), (1)) p(v)
        left join churn_labels on churned = a.v and churn_label = p.v group by a.v, p.v""",
    "roc_auc": """
        select cast(sum(pos * (2 * neg_before + neg)) as double)
                   / (2e0 * cast(sum(pos) as double) * cast(sum(neg) as double)) as auc
        from (select pos, neg, coalesce(sum(neg) over (order by x
                         rows between unbounded preceding and 1 preceding), 0) as neg_before
              from (select churn_probability as x,
                           count(*) filter (where return_rate > 0.5) as pos,
                           count(*) filter (where return_rate <= 0.5) as neg
                    from churn_labels group by x))""",
    "risk_band_members": "select * from predictions where churn_risk = 'Medium'",
    "risk_band_all": "select * from predictions",
    "risk_counts": """
        select count(*) filter (where churn_risk = 'High') as high_risk,
               count(*) filter (where churn_risk = 'Medium') as medium_risk,
               count(*) filter (where churn_risk = 'Low') as low_risk
        from predictions""",
    "risk_breakdown": f"""
        select churn_risk, count(*) as customers,
               {_mean(f"sum({CENTS})", "count(total_revenue)")} as avg_revenue
        from predictions group by churn_risk""",
    "high_risk_by_city": """
        select city, count(*) as high_risk_customers from predictions
        where churn_risk = 'High' and city is not null group by city""",
    "high_risk_count": """
        select count(*) as high_risk_customers from predictions where churn_risk = 'High'""",
    "probability_histogram": """
        select least(cast(floor(churn_probability * 30) as bigint) + 1, 30) as bin, churn_risk,
               count(*) as customers
        from predictions group by all""",
    "risk_table": """
        select customer_name, city, acquisition_channel, completed_orders, total_revenue,
               days_since_last_order, churn_probability, churn_risk
        from predictions""",
    "training_series": "select * from series",
    "series_profile": f"""
        select min(ds) as first_day, max(ds) as last_day, count(*) as days,
               {_mean(f"sum({_cents('y')})", "count(y)")} as mean_revenue
        from series""",
    "future_frame": "select * from calendar",
    "seasonal_features": _seasonal(),
    # no row breaks the mart's definition, and the fit is at the least value of its penalised squares
    "revenue_forecast_checks": """
        select count(*) as days,
               count(*) filter (where ds <= (select max(order_date) from daily)) as actual_days,
               (select count(*) from series) as fitted_days, cast(0 as bigint) as disordered,
               cast(0 as bigint) as wrong_widths
        from calendar""",
    "forecast_derivatives": "select count(*) as days, 0e0 as derivative from series",
    "category_daily_revenue": "select * from category_daily",
    "category_forecast_calendar": "select * from category_kinds",
    "category_forecast_checks": f"""
        select category, count(*) as days,
               count(*) filter (where record_type = 'actual') as actual_days,
               (select count(*) from category_daily d
                where d.category = k.category and order_date < date '{TRAIN_BEFORE}')
                   as fitted_days,
               cast(0 as bigint) as disordered, cast(0 as bigint) as wrong_widths
        from category_kinds k group by category""",
    "category_forecast_derivatives": f"""
        select category, count(*) as days, 0e0 as derivative
        from category_daily where order_date < date '{TRAIN_BEFORE}' group by category""",
    "forecast_mart_by_rule": "select * from forecast",
    "forecast_horizon": """
        select ds as date, yhat as predicted, yhat_lower as lower_bound,
               yhat_upper as upper_bound
        from yhat where ds > (select max(ds) from series)""",
    "forecast_table": """
        select forecast_date, predicted_revenue, lower_bound, upper_bound
        from forecast where record_type = 'forecast'""",
    "forecast_history": "select * from forecast where record_type = 'actual'",
    "forecast_total": f"""
        select {_hu(f"sum({_cents('predicted_revenue')})", "100")} / 1e0 as total
        from forecast where record_type = 'forecast'""",
    "forecast_next_7": _HORIZON.format("limit 7"),
    "forecast_next_30": _HORIZON.format(""),
    "record_type_breakdown": f"""
        select record_type, count(*) as days,
               round(cast(sum({_cents("predicted_revenue")}) as double)
                     / (count(predicted_revenue) * 100e0), 0) as avg_daily_revenue
        from forecast group by record_type""",
    "stream_events": "select * from stg_events",
    "stream_daily_counts": """
        select event_date, event_type, count(*) as events from stg_events
        group by event_date, event_type""",
    "daily_event_counts": """
        select event_date, event_type, count(*) as events from stg_events
        group by event_date, event_type""",
}


def oracles() -> dict[str, str]:
    shared = ",\n".join(f"{name} as ({body})" for name, body in TABLES.items())
    return {name: f"with {shared}\n{select}" for name, select in SELECTS.items()}
