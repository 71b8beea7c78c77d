"""DuckDB SQL that each query must agree with, over the driver's tables."""

from __future__ import annotations

#: The events as raw clickstream events (raw), with the first failing rule (tagged), normalised (clean), each once (stored), and by minute (cube).
EVENTS = r"""
with k0 as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events),
k1 as (select *, case event_type
    when 'view' then case when event_id % 5 = 0 then 'WISHLIST' else 'VIEW' end
    when 'click' then case when event_id % 4 = 0 then 'REMOVE_CART' else 'ADD_TO_CART' end
    when 'signup' then case when event_id % 6 = 0 then 'ORDER_CANCELLED' else 'ORDER_CREATED' end
    when 'purchase' then case when event_id % 8 = 0 then 'REFUND' else 'PAYMENT_SUCCESS' end
    else 'PAYMENT_FAILED' end as kind from k0),
base as (select cast(event_id as varchar) as event_id,
    'sess-' || user_id || '-' || cast(cast(ts as date) as varchar) as session_id, ts as event_time, kind as event_type,
    ['web', 'Browser', 'iPhone', 'Android_App', 'PWA', 'SmartTV', 'iPad'][event_id % 7 + 1] as device,
    '10.0.' || event_id % 256 || '.' || k % 256 as ip,
    case when event_id % 10 >= 3 then 'USR-' || lpad(cast(user_id as varchar), 5, '0') end as user_id,
    case when k % 23 <> 0 then 'SKU-' || k % 100 end as product_id,
    case when k % 23 <> 0 then case when k % 3 = 0 then '  ' || upper(['electronics', 'fashion', 'home', 'beauty', 'sports', 'books', 'toys', 'grocery', 'automotive', 'garden'][k % 10 + 1]) || ' '
        else ['electronics', 'fashion', 'home', 'beauty', 'sports', 'books', 'toys', 'grocery', 'automotive', 'garden'][k % 10 + 1] end end as category,
    case when kind not in ('VIEW', 'WISHLIST', 'REMOVE_CART') then cast((1 + k % 3) * (case when event_id % 97 = 0 then -1 else 1 end) as integer) end as quantity,
    case when kind not in ('VIEW', 'WISHLIST', 'REMOVE_CART') then value * (case when event_id % 97 = 0 then -1 else 1 end) end as price,
    case when kind in ('ORDER_CREATED', 'PAYMENT_SUCCESS', 'PAYMENT_FAILED', 'REFUND') then ['credit_card', 'debit_card', 'upi', 'net_banking', 'wallet', 'cod', 'emi'][event_id % 7 + 1] end as payment_mode
    from k1),
raw as (select * from base union all select * replace (event_time + interval 1 minute as event_time) from base where cast(event_id as bigint) % 10 = 0),
tagged as (select *, case when quantity < 0 then 'quantity must be >= 0, got: ' || quantity when price < 0 then 'price must be >= 0, got: ' || price end as reason,
    case when quantity < 0 then 'quantity must be >= 0, got: ' || quantity when price < 0 then 'price must be >= 0, got: ' || price
         when abs(epoch_us(event_time) // 1000 - epoch_us(timestamp '2024-01-16') // 1000) > 172800000
         then 'event_time out of ±48h window: ' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.') || lpad(cast((epoch_us(event_time) // 1000) % 1000 as varchar), 3, '0') || 'Z (now=2024-01-16T00:00:00.000Z)' end as reason48 from raw),
normal as (select event_id, session_id, event_time, event_type, case when lower(device) in ('web', 'browser', 'desktop', 'pwa') then 'web' when lower(device) in ('android', 'android_app') then 'android'
        when lower(device) in ('ios', 'iphone', 'ipad', 'ios_app') then 'ios' else 'other' end as device, ip, user_id, product_id, lower(trim(category)) as category, quantity, price, payment_mode, reason, reason48 from tagged),
stored as (select * exclude (rn, reason, reason48) from (select *, row_number() over (partition by event_id order by event_time) as rn from normal where reason is null) where rn = 1),
cube as (select date_trunc('minute', event_time) as minute, event_type, category, payment_mode, device, 1 as events, coalesce(quantity, 0) as qty, coalesce(price, 0.0) as revenue, user_id from stored),
now as (select max(ts) as t from events)
"""

R2 = "floor(({0}) * 100.0 + 0.5) / 100.0"
R1 = "floor(({0}) * 10.0 + 0.5) / 10.0"
R4 = "floor(({0}) * 10000.0 + 0.5) / 10000.0"
CENTS = "round(({0}) * 100.0) / 100.0"


def n(kind: str, measure: str = "events") -> str:
    return f"coalesce(sum({measure}) filter (event_type = '{kind}'), 0)"


def i(kind: str) -> str:
    return f"cast({n(kind)} as bigint)"


def paid() -> str:
    return CENTS.format(n("PAYMENT_SUCCESS", "revenue"))


def div(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif(cast({b} as double), 0)"


KPI = f"""select time_bucket(interval 1 minute, event_time) as window_start, category, event_type, count(*) as events, sum(coalesce(quantity, 0)::double) as total_qty,
    {CENTS.format('sum(coalesce(price, 0) * coalesce(quantity, 0))')} as total_revenue, count(distinct user_id) as unique_users from stored group by 1, 2, 3"""
FUNNEL = f"""select *, {R2.format('carts::double / nullif(views, 0) * 100.0')} as view_to_cart_pct, {R2.format('orders::double / nullif(carts, 0) * 100.0')} as cart_to_order_pct,
    {R2.format('payments::double / nullif(orders, 0) * 100.0')} as order_to_pay_pct, {R2.format('payments::double / nullif(views, 0) * 100.0')} as overall_cvr_pct from (
    select time_bucket(interval 5 minute, event_time) as window_start, category, count(*) filter (event_type = 'VIEW') as views, count(*) filter (event_type = 'ADD_TO_CART') as carts,
    count(*) filter (event_type = 'ORDER_CREATED') as orders, count(*) filter (event_type = 'PAYMENT_SUCCESS') as payments,
    {CENTS.format("sum(case when event_type = 'PAYMENT_SUCCESS' then coalesce(price, 0) * coalesce(quantity, 0) else 0.0 end)")} as revenue from stored group by 1, 2)"""


def funnel(column: str, hours: int, sort: str = "views") -> str:
    return f"""select *, {R4.format('payments::double / nullif(views, 0)')} as conversion_rate from (select {column}, count(*) filter (event_type = 'VIEW') as views, count(*) filter (event_type = 'ADD_TO_CART') as carts,
    count(*) filter (event_type = 'ORDER_CREATED') as orders, count(*) filter (event_type = 'PAYMENT_SUCCESS') as payments from stored, now where event_time >= t - interval {hours} hour group by 1)
    order by {sort} desc nulls last, {column} asc nulls last limit 20"""


LABEL = "coalesce(category, '(uncategorised)')"

_EVENT_QUERIES = {
    "clean_events": "select * exclude (reason, reason48) from normal where reason48 is null",
    "dlq_events": "select reason48 as reason, event_id, event_time, cast(1705363200000 as bigint) as ingest_ts from tagged where reason48 is not null",
    "dlq_envelope": "select reason, event_id, event_type, category, quantity from tagged where reason is not null",
    "dlq_reason_counts": "select case when reason48 is null then 'valid' else split_part(reason48, ' ', 1) end as rule, count(*) as events from tagged group by 1",
    "dedup_first_seen": "select event_id, event_time, event_type from (select *, row_number() over (partition by event_id order by event_time) as rn from raw) where rn = 1",
    "dedup_short_ttl": "select event_id, event_time, event_type from raw",
    "dedup_counters": "select count(*) as received, count(distinct event_id) as forwarded, count(*) - count(distinct event_id) as duplicates_dropped from raw",
    "rollup_1min": f"select minute, event_type, category, payment_mode, device, cast(sum(events) as bigint) as events, cast(sum(qty) as bigint) as qty, {CENTS.format('sum(revenue)')} as revenue from cube group by all",
    "kpi_1min": KPI,
    "kpi_1min_merge_equivalence": KPI,
    "funnel_5min": FUNNEL,
    "funnel_backfill": FUNNEL.replace("from stored group", "from (select * exclude (rn) from (select *, row_number() over (partition by event_type, category, event_id order by event_time desc) as rn from normal where reason is null) where rn = 1) group"),
    "rollup_hll_error": "select category, count(distinct user_id) as users, true as within_bound from stored group by 1",
    "dlq_rate_alerts": "select * from (select date_trunc('day', event_time) as window_start, count(*) as events, count(reason) as rejected from tagged group by 1) where rejected > events * 0.01::double",
    "kpi_latest": f"select k.* from ({KPI}) k, now where window_start >= date_trunc('minute', t) - interval 1 hour order by window_start desc, total_revenue desc, event_type, category asc nulls last limit 50",
    "funnel_latest": f"select f.* from ({FUNNEL}) f, now where window_start >= t - interval 6 hour",
    "kpi_backfill": f"""select event_type, count(*) as events, sum(coalesce(quantity, 0)::double) as total_qty, {CENTS.format('sum(coalesce(price, 0) * coalesce(quantity, 0))')} as total_revenue from stored group by 1""",
    "hourly_category": f"select date_trunc('hour', event_time) as hour, category, count(*) as events, {CENTS.format('sum(coalesce(price, 0.0))')} as revenue from stored group by 1, 2",
    "revenue_by_category": f"""select *, {R2.format(div('total_revenue', 'paid_orders'))} as avg_order_value from (select {LABEL} as category, {i('PAYMENT_SUCCESS')} as paid_orders, {paid()} as total_revenue,
        count(distinct user_id) as approx_buyers from cube, now where minute >= t - interval 24 hour group by 1)""",
    "event_types_last_hour": f"""select event_type, event_count, {R2.format('100.0 * (event_count::double / sum(event_count) over ())')} as pct_of_total, {R1.format('event_count / 60.0::double')} as events_per_minute
        from (select event_type, cast(sum(events) as bigint) as event_count from cube, now where minute >= t - interval 1 hour group by 1) order by event_count desc, event_type limit 10""",
    "payment_success_by_mode": f"""select *, successes + failures as total_attempts, {R2.format('100.0 * (' + div('successes', 'successes + failures') + ')')} as success_rate_pct from (
        select payment_mode, {i('PAYMENT_SUCCESS')} as successes, {i('PAYMENT_FAILED')} as failures, {paid()} as total_revenue_collected from cube, now
        where minute >= t - interval 168 hour and payment_mode is not null group by 1)""",
    "hourly_timeseries": f"""select date_trunc('hour', minute) as hour_bucket, cast(sum(events) as bigint) as total_events, {i('VIEW')} as views, {i('ADD_TO_CART')} as add_to_carts, {i('ORDER_CREATED')} as orders_created,
        {i('PAYMENT_SUCCESS')} as payments_succeeded, {i('PAYMENT_FAILED')} as payments_failed, {paid()} as hourly_revenue from cube, now where minute >= t - interval 72 hour group by 1""",
    "unique_users_by_device": f"""select *, {R1.format('100.0 * (total_events::double / sum(total_events) over ())')} as pct_of_traffic from (select device, cast(sum(events) as bigint) as total_events, count(distinct user_id) as approx_unique_users,
        {CENTS.format('sum(revenue)')} as total_revenue from cube, now where minute >= date_trunc('day', t) group by 1)""",
    "cart_abandonment": f"""select *, {R1.format('100.0 * (1.0 - ' + div('order_created_events', 'add_to_cart_events') + ')')} as cart_abandonment_pct from (select {LABEL} as category, {i('ADD_TO_CART')} as add_to_cart_events, {i('REMOVE_CART')} as remove_cart_events,
        {i('ORDER_CREATED')} as order_created_events, {i('PAYMENT_SUCCESS')} as payment_success_events from cube, now where minute >= t - interval 720 hour group by 1) where add_to_cart_events > 50""",
    "aov_by_hour_of_day": f"""select * exclude (items), {R2.format(div('total_revenue', 'total_orders'))} as avg_order_value, {R2.format(div('items', 'total_orders'))} as avg_items_per_order from (select extract(hour from minute) as hour_of_day,
        count(distinct cast(minute as date)) as days_observed, {i('PAYMENT_SUCCESS')} as total_orders, {paid()} as total_revenue, {n('PAYMENT_SUCCESS', 'qty')} as items from cube, now where minute >= t - interval 168 hour group by 1)""",
    "event_type_distribution": f"""select event_type, event_count, {R2.format('100.0 * (event_count::double / sum(event_count) over ())')} as percentage, revenue_contribution from (
        select event_type, cast(sum(events) as bigint) as event_count, {paid()} as revenue_contribution from cube, now where minute >= t - interval 24 hour group by 1)""",
    "peak_hours": f"""select *, floor(total_events_30d::double / days_in_sample + 0.5) as avg_events_per_day_at_hour, max(total_events_30d) over (order by total_events_30d desc, hour_of_day rows unbounded preceding) as running_max,
        {R2.format('100.0 * (total_events_30d::double / sum(total_events_30d) over ())')} as pct_of_daily_traffic from (select extract(hour from minute) as hour_of_day, count(distinct cast(minute as date)) as days_in_sample,
        cast(sum(events) as bigint) as total_events_30d from cube, now where minute >= t - interval 720 hour group by 1)""",
    "category_leaderboard": f"""select category, total_events, views, add_to_carts, orders, payments, unique_shoppers, gross_revenue, {R2.format('100.0 * (' + div('add_to_carts', 'views') + ')')} as view_to_cart_pct,
        {R2.format('100.0 * (' + div('orders', 'add_to_carts') + ')')} as cart_to_order_pct, {R2.format('100.0 * (' + div('payments', 'orders') + ')')} as order_to_payment_pct, {R2.format('100.0 * (' + div('payments', 'views') + ')')} as overall_conversion_pct,
        {R2.format(div('gross_revenue', 'payments'))} as avg_order_value, {R2.format('100.0 * (' + div('refunds', 'payments') + ')')} as refund_rate_pct from (select {LABEL} as category, cast(sum(events) as bigint) as total_events, {i('VIEW')} as views,
        {i('ADD_TO_CART')} as add_to_carts, {i('ORDER_CREATED')} as orders, {i('PAYMENT_SUCCESS')} as payments, {i('REFUND')} as refunds, count(distinct user_id) as unique_shoppers, {paid()} as gross_revenue from cube, now where minute >= t - interval 168 hour group by 1)""",
    "minute_rollup_top20": f"""select minute, event_type, category, cast(sum(events) as bigint) as event_count, cast(sum(qty) as bigint) as total_qty, {CENTS.format('sum(revenue)')} as total_revenue, count(distinct user_id) as approx_users
        from cube, now where minute >= t - interval 1 hour group by 1, 2, 3 order by minute desc, event_count desc, event_type, category asc nulls last limit 20""",
    "per_minute_by_type": f"select minute, event_type, cast(sum(events) as bigint) as events, {CENTS.format('sum(revenue)')} as revenue from cube, now where minute >= t - interval 10 minute group by 1, 2 order by minute desc, event_type limit 20",
    "realtime_kpis": f"""select revenue, orders, active_users, coalesce({div('revenue', 'orders')}, 0.0) as avg_order_value, coalesce({div('payers', 'carters')}, 0.0) as cart_conversion_rate from (
        select coalesce({CENTS.format("sum(price) filter (event_type = 'PAYMENT_SUCCESS')")}, 0.0) as revenue, count(distinct event_id) filter (event_type = 'PAYMENT_SUCCESS') as orders, count(distinct user_id) as active_users,
        count(distinct user_id) filter (event_type = 'PAYMENT_SUCCESS') as payers, count(distinct user_id) filter (event_type = 'ADD_TO_CART') as carters from stored, now where event_time >= t - interval 24 hour)""",
    "funnel_by_category": funnel("category", 720),
    "funnel_by_conversion": funnel("category", 720, "conversion_rate"),
    "funnel_by_event_type": funnel("event_type", 168),
    "global_funnel": f"""select *, coalesce({div('carts', 'views')}, 0.0) as cart_rate, coalesce({div('orders', 'carts')}, 0.0) as order_rate, coalesce({div('payments', 'orders')}, 0.0) as payment_rate, coalesce({div('payments', 'views')}, 0.0) as overall_rate
        from (select cast(sum(views) as bigint) as views, cast(sum(carts) as bigint) as carts, cast(sum(orders) as bigint) as orders, cast(sum(payments) as bigint) as payments from ({funnel('category', 720)}))""",
    "top5_categories": f"select left({LABEL}, 12) as category, views, payments from ({funnel('category', 720)}) order by views desc, category asc nulls last limit 5",
    "top_products": f"""select product_id, revenue, units_sold, {R2.format('revenue / units_sold')} as avg_price from (select product_id, {CENTS.format('sum(price)')} as revenue, count(*) as units_sold from stored, now
        where event_time >= t - interval 168 hour and event_type = 'PAYMENT_SUCCESS' and product_id <> '' group by 1) order by revenue desc, product_id limit 10""",
    "live_events": """select event_id, event_type, user_id, product_id, price, strftime(event_time, '%Y-%m-%d %H:%M:%S.') || lpad(cast((epoch_us(event_time) // 1000) % 1000 as varchar), 3, '0') as timestamp
        from stored order by event_time desc, event_id desc limit 100""",
    "live_payments": "select event_id, user_id, price from stored where event_type = 'PAYMENT_SUCCESS' order by event_time desc, event_id desc limit 200",
    "events_last_n": "select event_type, count(*) as events from stored, now where event_time > t - interval 86400 second group by 1",
    "user_days": "select date_trunc('day', event_time)::timestamp as day, count(*) as events from stored where user_id = 'USR-00007' group by 1",
    "timeseries_native": f"""select *, {R4.format(div('revenue', 'events'))} as revenue_per_event from (select time_bucket(interval 1 hour, event_time) as timestamp, count(*) as events, count(*) filter (event_type = 'PAYMENT_SUCCESS') as payments,
        {CENTS.format("coalesce(sum(price) filter (event_type = 'PAYMENT_SUCCESS'), 0.0)")} as revenue from stored, now where event_time >= t - interval 3 day and event_time < t and device = 'web' group by 1)""",
    "erasure_preview": "select count(*) filter (user_id = 'USR-00007') as rows_deleted, count(*) filter (user_id is distinct from 'USR-00007') as rows_kept from stored",
    "erased_events": "select event_type, count(*) as events, count(user_id) as of_users from stored where user_id is distinct from 'USR-00007' group by 1",
}
for _g, (_width, _hours) in {"1m": ("1 minute", 24), "5m": ("5 minute", 24), "15m": ("15 minute", 24), "1h": ("1 hour", 720), "1d": ("1 day", 720)}.items():
    _EVENT_QUERIES[f"revenue_timeseries_{_g}"] = f"""select time_bucket(interval {_width}, event_time) as bucket, coalesce({CENTS.format("sum(price) filter (event_type = 'PAYMENT_SUCCESS')")}, 0.0) as revenue
        from stored, now where event_time >= t - interval {_hours} hour group by 1"""

_CHECKS = [
    ("event_id_not_null", "event_id", "count(*)", "event_id is not null", 1.0), ("event_id_length", "event_id", "count(event_id)", "length(event_id) >= 8", 1.0),
    ("event_id_pattern", "event_id", "count(event_id)", r"regexp_matches(event_id, '^[0-9a-fA-F\-]{8,}$')", 1.0), ("event_time_not_null", "event_time", "count(*)", "event_time is not null", 1.0),
    ("event_time_recent", "event_time", "count(event_time)", "event_time between timestamp '2024-01-14' and timestamp '2024-01-16 00:05:00'", 1.0), ("session_id_not_null", "session_id", "count(*)", "session_id is not null", 1.0),
    ("session_id_length", "session_id", "count(session_id)", "length(session_id) >= 8", 1.0), ("event_type_not_null", "event_type", "count(*)", "event_type is not null", 1.0),
    ("event_type_in_set", "event_type", "count(event_type)", "event_type in ('VIEW', 'ADD_TO_CART', 'REMOVE_CART', 'WISHLIST', 'ORDER_CREATED', 'ORDER_CANCELLED', 'PAYMENT_SUCCESS', 'PAYMENT_FAILED', 'REFUND')", 1.0),
    ("device_not_null", "device", "count(*)", "device is not null", 1.0), ("device_in_set", "device", "count(device)", "device in ('web', 'android', 'ios', 'other')", 1.0), ("price_not_negative", "price", "count(price)", "price >= 0", 0.99),
    ("quantity_in_range", "quantity", "count(quantity)", "quantity between 0 and 10000", 0.999), ("category_pattern", "category", "count(category)", "regexp_matches(category, '^[a-z][a-z0-9_]*$')", 0.98),
    ("event_time_ordered", "event_time", "count(event_time)", "event_time >= event_time", 1.0),
]
_EVENT_QUERIES["dq_suite"] = " union all ".join(
    f"select cast({at} as integer) as place, '{name}' as expectation, '{column}' as \"column\", {seen} as evaluated, count(*) filter ({ok}) as passed, {seen} = 0 or count(*) filter ({ok}) / nullif({seen}::double, 0) >= {share} as success from stored"
    for at, (name, column, seen, ok, share) in enumerate(_CHECKS)
) + " union all select cast(15 as integer), 'row_count', '*', count(*), case when count(*) >= 4 then count(*) else 0 end, count(*) >= 4 from stored"

_PHASE = "case event_type when 'signup' then 'warmup' when 'error' then 'steady_low' when 'click' then 'steady_mid' when 'view' then 'steady_high' else 'recovery' end"
_METRICS = f"(select {_PHASE} as phase, ts, event_id, value, case when event_id % 50 = 0 then -1 else event_id % 1000 end as lag, case when event_id % 100 = 0 then (event_id % 80)::double end as recovered from events)"
_MEANS = {
    "produce_rate_mean": "value * 100", "consume_rate_mean": "value * 90", "latency_p50_mean": "value", "latency_p95_mean": "value * 2", "latency_p99_mean": "value * 3", "lag_mean": "lag", "checkpoint_mean_ms": "(event_id % 5000)",
    "checkpoint_size_mean_mb": "(event_id % 64)", "coordinator_cpu_mean": "(event_id % 90)", "coordinator_memory_mean_mb": "(event_id % 2048)", "worker_cpu_mean": "(event_id % 70)", "worker_memory_mean_mb": "(event_id % 4096)",
    "broker_cpu_mean": "(event_id % 50)", "broker_memory_mean_mb": "(event_id % 1024)",
}
_LOGS = """(select event_id, ts, case event_id % 3 when 0 then 'stream' when 1 then 'broker' else 'store' end as service, event_id % 11 = 0 as bad, event_id // 3 % (case event_id % 3 when 0 then 5 else 3 end) as form from events)"""
_TAGS = """case when bad then 'parse_failure' when service = 'stream' then ['checkpoint_failure', 'backpressure,application_error', 'checkpoint_triggered', 'deduplication', 'application_error,stack_trace'][form + 1]
        when service = 'broker' then ['isr_change', 'leader_election', 'application_error,under_replicated'][form + 1] else [case when event_id % 10 * 1000 + 500 > 5000 then 'slow_query' else '' end, 'materialized_view', 'application_error,complex_query'][form + 1] end"""

OTHER = {
    "latest_version": "select event_type, user_id % 10 as shard, max(ts) as ingest_ts, arg_max(event_id, ts) as event_id from events group by 1, 2",
    "upsert_events": "select event_id, case when event_id % 7 = 0 then 'corrected' else event_type end as event_type, case when event_id % 7 = 0 then 0.0 else value end as value from events",
    "produced_consumed_latency": "select event_id, (event_id % 400 - 20) * 1000.0::double as latency_ms from events where event_id % 3 <> 0 and event_id % 400 - 20 > 0 and event_id % 400 - 20 < 300",
    "sample_every_nth": "select event_id, event_type, value from (select event_id, event_type, value, row_number() over (order by event_id) - 1 as r, greatest(1, count(*) over () // 100) as step from events) where r % step = 0 and r < step * 100",
    "keep_newest_k": "select event_id, event_type as job_id, ts as created_at from (select *, row_number() over (partition by event_type order by ts desc) as rn from events) where rn > 2 and ts < timestamp '2024-01-16'",
    "retention_expired": "select cast(ts as date) as partition, count(*) as rows from events where cast(ts as date) < date '2024-01-17' group by 1",
    "service_health": "select case when bool_and(up) then 'healthy' else 'degraded' end as status, count(*) as components from (select event_type, max(value) > 300 as up from events group by 1)",
    "latency_percentiles": """select event_type, count(*) as samples, list_sort(list(value))[cast(least(floor(count(*) * 0.5), count(*) - 1) as bigint) + 1] as p50, list_sort(list(value))[cast(least(floor(count(*) * 0.95), count(*) - 1) as bigint) + 1] as p95,
        list_sort(list(value))[cast(least(floor(count(*) * 0.99), count(*) - 1) as bigint) + 1] as p99 from events group by 1""",
    "phase_stats": f"""select phase, 1000 as target_rate, count(*) as rows, {", ".join(f"{CENTS.format(f'avg({v}) filter ({v} > 0)')} as {name}" for name, v in _MEANS.items())}, {CENTS.format('max(value * 100) filter (value >= 0)')} as produce_rate_max,
        {CENTS.format('max(value * 4)')} as latency_max, cast(sum(event_id % 100) as bigint) as latency_samples, max(lag) filter (lag >= 0) as lag_max, max(event_id % 5000) as checkpoint_max_ms, cast(sum(event_id % 3) as bigint) as errors, max(recovered) as recovery_s,
        {CENTS.format("(list_sort(list(value * 100) filter (value > 0)))[cast(least(floor(count(*) filter (value > 0) * 95.0::double / 100), count(*) filter (value > 0) - 1) as bigint) + 1]")} as produce_rate_p95 from {_METRICS} group by 1""",
    "slo_verdicts": f"""with s as (select phase, avg(value * 2) as p95, avg(value * 3) as p99, avg(value * 100) as rate, max(lag) as lag, max(event_id % 5000) as cp, max(recovered) as rec from {_METRICS} where phase <> 'warmup' group by 1),
        t(slo, phase, target) as (values ('warmup_p99', 'warmup', 500.0::double), ('steady_low_p99', 'steady_low', 1000.0), ('steady_mid_p95', 'steady_mid', 2000.0), ('steady_high_p95', 'steady_high', 5000.0), ('steady_low_rate', 'steady_low', 9000.0),
            ('steady_high_rate', 'steady_high', 72000.0), ('checkpoint_ms', 'steady_low', 30000.0), ('lag', 'steady_low', 50000.0), ('recovery_s', 'recovery', 90.0))
        select slo, t.phase, target, case when v is null then 'NO DATA' when (case when slo like '%rate' then v >= target else v <= target end) then 'PASS' else 'FAIL' end as verdict from (
            select t.*, case when slo like '%p99' then p99 when slo like '%p95' then p95 when slo like '%rate' then rate when slo = 'checkpoint_ms' then cp when slo = 'lag' then lag else rec end as v from t left join s using (phase)) t""",
    "counter_rates": f"""select phase, ts, floor(grown / nullif(seconds, 0) * 1000000.0 + 0.5) / 1000000.0 as rate from (select phase, ts, (event_id - lag(event_id) over w)::double as grown, (epoch_us(ts) - lag(epoch_us(ts)) over w) / 1000000.0::double as seconds
        from {_METRICS} window w as (partition by phase order by ts))""",
    "parsed_logs": f"""select service, case when not bad then date_trunc('millisecond', ts) end as ts,
        case when bad then null when service = 'stream' then ['warn', 'error', 'info', 'info', 'error'][form + 1] else ['info', 'warn', 'error'][form + 1] end as level, case when service = 'stream' and form in (0, 2) and not bad then event_id end as checkpoint_id,
        case when service = 'stream' and not bad then case form when 0 then cast(event_id % 4 + 1 as integer) when 2 then 2 end end as subtask, case when service = 'broker' and not bad then case form when 0 then cast(event_id % 3 as integer) when 1 then 1 end end as leader_id,
        case when service = 'store' and form = 0 and not bad then event_id % 10 * 1000 + 500 end as elapsed_ms, case when bad then null when service = 'store' and form = 0 then event_id * 3 when service = 'stream' and form = 3 then event_id % 7 end as rows,
        {_TAGS} as tags from {_LOGS}""",
    "log_tag_counts": f"""select service, tag, count(*) as lines from (select service, unnest(string_split({_TAGS}, ',')) as tag from {_LOGS}) where tag <> '' group by 1, 2""",
    "metric_alerts": """select 'metrics-' || event_type || '-' || strftime(ts, '%Y.%m.%d') as index, alert, count(*) as records from (select event_type, ts, unnest([case when value + value / 4 > 80 then 'high_cpu' end, case when value / 2 > 85 then 'high_memory' end,
        case when event_id * 3 > 10000 then 'high_lag' end, case when event_id % 7 = 0 then 'no_running_jobs' end, case when value * 1e7 > 3758096384 then 'store_memory' end]) as alert from events) where alert is not null group by 1, 2""",
    "ext_revenue_by_nation": f"""select n_name, {CENTS.format('sum(l_extendedprice * (1 - l_discount))')} as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_nationkey, n_name""",
    "ext_pricing_summary": f"select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, {CENTS.format('sum(l_extendedprice)')} as sum_base_price, count(*) as count_order from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2",
    "ext_semi_join": "select c_mktsegment, count(*) as customers from customer where exists (select 1 from orders where o_custkey = c_custkey) group by 1",
    "ext_anti_join": "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')",
    "ext_full_join": """select coalesce(s_nationkey, c_nationkey) as nationkey, suppliers, customers from (select s_nationkey, count(*) as suppliers from supplier group by 1) s
        full join (select c_nationkey, count(*) as customers from customer where c_nationkey < 15 group by 1) c on s_nationkey = c_nationkey""",
    "ext_asof_join": """select p.event_id, p.user_id, v.value as last_view_value from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts""",
    "ext_range_join": """select p.user_id, count(*) as pairs from events p join events e on p.user_id = e.user_id and p.ts >= e.ts and p.ts < e.ts + interval 6 hour where p.event_type = 'purchase' and e.event_type = 'error' group by 1""",
    "ext_cube": "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as qty from lineitem group by cube (l_returnflag, l_linestatus)",
    "ext_rollup": "select o_orderstatus, o_orderpriority, count(*) as n from orders group by rollup (o_orderstatus, o_orderpriority)",
    "ext_statistics": "select l_returnflag, floor(stddev_samp(l_quantity) * 1000000.0 + 0.5) / 1000000.0 as sd, median(l_quantity) as median_qty, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by 1",
    "ext_window_functions": """select c_nationkey, customers, dense_rank() over (partition by c_nationkey % 5 order by customers desc) as dense, ntile(4) over w as quartile, floor(cume_dist() over w * 1000000.0 + 0.5) / 1000000.0 as cume,
        floor(percent_rank() over w * 1000000.0 + 0.5) / 1000000.0 as pct, lead(customers) over w as next, first_value(customers) over w as most, cast(sum(customers) over (partition by c_nationkey % 5 order by customers desc, c_nationkey rows between 1 preceding and 1 following) as bigint) as around
        from (select c_nationkey, count(*) as customers from customer group by 1) window w as (partition by c_nationkey % 5 order by customers desc, c_nationkey)""",
    "ext_grouping_sets": """select l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus) as level, count(*) as n, floor(var_pop(l_quantity) * 10000.0 + 0.5) / 10000.0 as variance,
        arg_max(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) as dearest, array_to_string(list_sort(list(distinct l_returnflag)), ',') as flags from lineitem group by grouping sets ((l_returnflag, l_linestatus), (l_linestatus), ())""",
    "ext_count_window": """select user_id, part, count(*) as events, min(ts) as first_ts, max(ts) as last_ts from (select user_id, ts, (row_number() over (partition by user_id order by ts, event_id) - 1) // 50 as part from events) group by 1, 2""",
    "ext_ranks": """select o_orderpriority, o_orderkey, rank, previous from (select *, rank() over w as rank, lag(o_totalprice) over w as previous from orders window w as (partition by o_orderpriority order by o_totalprice desc, o_orderkey)) where rank <= 10""",
    "ext_set_operations": """select c_nationkey as k, 'both' as side from (select c_nationkey from customer intersect select s_nationkey from supplier) union all select c_nationkey, 'customers' from (select c_nationkey from customer except select s_nationkey from supplier)
        union all select s_nationkey, 'suppliers' from (select s_nationkey from supplier except select c_nationkey from customer)""",
    "ext_sliding_window": """select window_start, event_type, count(*) as events from (select event_type, unnest([time_bucket(interval 1 day, ts), time_bucket(interval 1 day, ts) - interval 1 day]) as window_start from events) group by 1, 2""",
    "ext_session_window": """select user_id, min(ts) as session_start, count(*) as events from (select *, sum(case when fresh then 1 else 0 end) over (partition by user_id order by ts, event_id) as s from (
        select *, coalesce(ts >= lag(ts) over (partition by user_id order by ts, event_id) + interval 12 hour, true) as fresh from events)) group by user_id, s""",
}

#: What the jobs write, which is what plain queries over all events give.
_JOB_QUERIES = {
    "job_events": "select * from stored",
    "job_dead_letters": "select reason, event_id from tagged where reason is not null",
    "job_kpi_1min": KPI,
    "job_funnel_5min": FUNNEL,
    "job_rollup_1min": _EVENT_QUERIES["rollup_1min"],
    "job_rebuilt_kpi_1min": KPI,
    "compacted_events": "select * from stored",
    "retained_kpi_1min": f"select k.* from ({KPI}) k, now where cast(window_start as date) >= cast(t as date) - 10",
    "store_statistics": """select 'events' as "table", count(*) as rows, '' as warnings from stored union all select 'dead_letters', count(*), '' from tagged where reason is not null""",
    "erased_store": "select count(*) filter (user_id is distinct from 'USR-00007') as events, cast(0 as bigint) as of_user, 'ok' as status, count(*) filter (user_id = 'USR-00007') as rows_deleted from stored",
    "decoded_events": "select event_id, session_id, date_trunc('millisecond', event_time) as event_time, event_type, device, ip, user_id, product_id, category, quantity, price, payment_mode from raw where payment_mode is distinct from 'emi'",
    "decode_error_months": "select count(*) as errors, '2020-01' as dropped from raw where payment_mode = 'emi'",
    "stream_windows": f"""select date_trunc('day', event_time) as window_start, category, event_type, count(*) as events, {CENTS.format('sum(coalesce(price, 0) * coalesce(quantity, 0))')} as revenue
        from (select *, row_number() over (partition by event_id order by event_time) as rn from raw) where rn = 1 group by 1, 2, 3""",
    "missing_ids": "select distinct event_id, true as others_same from raw where event_id not in (select event_id from stored)",
    "live_then_polled": """select event_id, event_time, event_type from (select *, row_number() over (partition by event_type order by event_time desc) as place from (select *, row_number() over (partition by event_id order by event_time) as rn from raw) where rn = 1)
        where event_type = 'PAYMENT_SUCCESS' and place <= 120 or event_type = 'ORDER_CREATED' and place <= 200 - (select least(120, count(distinct event_id)) from raw where event_type = 'PAYMENT_SUCCESS')""",
}
_COMPACT = "case when {0} >= 1000000 then format('{{:,.1f}}M', {0} / 1000000.0) when {0} >= 1000 then format('{{:,.1f}}k', {0} / 1000.0) else format('{{:,}}', {0}) end"
OTHER |= {
    "snapshot_upsert": "select cast(event_id as varchar) as event_id, case when event_type = 'error' then 'corrected' else event_type end as event_type, case when event_type = 'error' then 0.0 else value end as value from events",
    "metrics_round_trip": f"""select event_type as phase, count(*) as rows, cast(sum(case when event_type = 'view' then -1 else event_id end) as bigint) as lag, cast(count(*) filter (event_type <> 'error') as bigint) as errors, 0.0::double as p99,
        {CENTS.format('sum(value)')} as rate, cast(0 as bigint) as malformed from events group by 1""",
    "stream_latency": OTHER["produced_consumed_latency"],
    "savepoint_inventory": "select event_type as job_id, count(distinct date_trunc('minute', ts)) as savepoints, max(date_trunc('minute', ts)) as newest from events group by 1",
    "bound_parameters": "select event_type, count(*) as n, cast(sum(event_id) as bigint) as ids, 'events:' || md5('least=100.0') as cache_key from events where value >= 100.0 and event_type <> 'vi''ew' group by 1",
    "display_formats": f"select o_orderpriority, format('${{:,.2f}}', n + 0.25) as usd, {_COMPACT.format('(n * 1000)')} as thousands, {_COMPACT.format('n')} as plain, '12.5%' as pct from (select o_orderpriority, count(*) as n from orders group by 1)",
    "generator_rules": "select cast(0 as bigint) as too_long, cast(0 as bigint) as paid_unordered, cast(0 as bigint) as paid_twice, cast(0 as bigint) as repeated_ids, true as same_again",
}

ORACLES: dict[str, str] = {name: EVENTS + sql for name, sql in (_EVENT_QUERIES | _JOB_QUERIES).items()} | OTHER
