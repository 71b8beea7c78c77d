"""The named analytical queries. `cube` is a minute rollup or measures(events); `events` are stored events; as_of stands for now."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.expr import GRANULARITY, WINDOW_HOURS, bucket, cents, period_hours, ratio, rounded, since

NO_CATEGORY = "(uncategorised)"
#: Columns that a funnel may be grouped by.
GROUPS = ("category", "event_type", "device", "payment_mode", "product_id")


def _of(measure: str, *types: str) -> Column:
    """Sum of a rollup measure over event types; 0 if there are none."""
    return F.sum(F.when(F.col("event_type").isin(*types), F.col(measure)).otherwise(0))


def _share(measure: Column, digits: int) -> Column:
    """Percent of the sum over the whole result, which is as many rows as there are groups."""
    return rounded(100.0 * ratio(measure, F.sum(measure).over(Window.partitionBy())), digits)


def _label() -> Column:
    return F.coalesce("category", F.lit(NO_CATEGORY)).alias("category")


def _recent(df: DataFrame, column: str, as_of: datetime.datetime, hours: float) -> DataFrame:
    return df.where(since(F.col(column), as_of, hours))


def revenue_by_category(cube: DataFrame, as_of: datetime.datetime, exact: bool = True) -> DataFrame:
    """Buyers are all users of the category; exact counts them, otherwise a HyperLogLog estimate stands in."""
    users = F.count_distinct("user_id") if exact else F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12))
    g = _recent(cube, "minute", as_of, 24).groupBy(_label()).agg(_of("events", "PAYMENT_SUCCESS").alias("paid_orders"), cents(_of("revenue", "PAYMENT_SUCCESS")).alias("total_revenue"), users.alias("approx_buyers"))
    return g.select("category", "paid_orders", "total_revenue", rounded(ratio(F.col("total_revenue"), F.col("paid_orders"))).alias("avg_order_value"), "approx_buyers").orderBy(F.desc("total_revenue"), "category")


def event_types_last_hour(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    g = _recent(cube, "minute", as_of, 1).groupBy("event_type").agg(F.sum("events").alias("event_count"))
    g = g.select("event_type", "event_count", _share(F.col("event_count"), 2).alias("pct_of_total"), rounded(F.col("event_count") / 60.0, 1).alias("events_per_minute"))
    return g.orderBy(F.desc("event_count"), "event_type").limit(10)


def payment_success_by_mode(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    g = _recent(cube, "minute", as_of, 168).where("payment_mode is not null").groupBy("payment_mode")
    g = g.agg(_of("events", "PAYMENT_SUCCESS").alias("successes"), _of("events", "PAYMENT_FAILED").alias("failures"), cents(_of("revenue", "PAYMENT_SUCCESS")).alias("total_revenue_collected"))
    g = g.withColumn("total_attempts", F.col("successes") + F.col("failures")).withColumn("success_rate_pct", rounded(100.0 * ratio(F.col("successes"), F.col("total_attempts"))))
    return g.select("payment_mode", "successes", "failures", "total_attempts", "success_rate_pct", "total_revenue_collected").orderBy(F.desc("total_attempts"), "payment_mode")


def hourly_timeseries(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    kinds = {"views": "VIEW", "add_to_carts": "ADD_TO_CART", "orders_created": "ORDER_CREATED", "payments_succeeded": "PAYMENT_SUCCESS", "payments_failed": "PAYMENT_FAILED"}
    g = _recent(cube, "minute", as_of, 72).groupBy(F.date_trunc("HOUR", "minute").alias("hour_bucket"))
    return g.agg(F.sum("events").alias("total_events"), *[_of("events", t).alias(n) for n, t in kinds.items()], cents(_of("revenue", "PAYMENT_SUCCESS")).alias("hourly_revenue")).orderBy("hour_bucket")


def unique_users_by_device(cube: DataFrame, as_of: datetime.datetime, exact: bool = True) -> DataFrame:
    users = F.count_distinct("user_id") if exact else F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12))
    today = cube.where(F.col("minute") >= F.date_trunc("DAY", F.lit(as_of)))
    g = today.groupBy("device").agg(F.sum("events").alias("total_events"), users.alias("approx_unique_users"), cents(F.sum("revenue")).alias("total_revenue"))
    return g.withColumn("pct_of_traffic", _share(F.col("total_events"), 1)).orderBy(F.desc("total_events"), "device")


def cart_abandonment(cube: DataFrame, as_of: datetime.datetime, least_carts: int = 50, hours: int = 720) -> DataFrame:
    kinds = {"add_to_cart_events": "ADD_TO_CART", "remove_cart_events": "REMOVE_CART", "order_created_events": "ORDER_CREATED", "payment_success_events": "PAYMENT_SUCCESS"}
    g = _recent(cube, "minute", as_of, hours).groupBy(_label()).agg(*[_of("events", t).alias(n) for n, t in kinds.items()]).where(F.col("add_to_cart_events") > least_carts)
    pct = rounded(100.0 * (1.0 - ratio(F.col("order_created_events"), F.col("add_to_cart_events"))), 1)
    return g.withColumn("cart_abandonment_pct", pct).orderBy(F.desc("cart_abandonment_pct"), "category")


def aov_by_hour_of_day(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    g = _recent(cube, "minute", as_of, 168).groupBy(F.hour("minute").cast("bigint").alias("hour_of_day")).agg(
        F.count_distinct(F.to_date("minute")).alias("days_observed"), _of("events", "PAYMENT_SUCCESS").alias("total_orders"),
        cents(_of("revenue", "PAYMENT_SUCCESS")).alias("total_revenue"), _of("qty", "PAYMENT_SUCCESS").alias("_items"),
    )
    return g.select(
        "hour_of_day", "days_observed", "total_orders", "total_revenue", rounded(ratio(F.col("total_revenue"), F.col("total_orders"))).alias("avg_order_value"),
        rounded(ratio(F.col("_items"), F.col("total_orders"))).alias("avg_items_per_order"),
    ).orderBy("hour_of_day")


def event_type_distribution(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    g = _recent(cube, "minute", as_of, 24).groupBy("event_type").agg(F.sum("events").alias("event_count"), cents(_of("revenue", "PAYMENT_SUCCESS")).alias("revenue_contribution"))
    return g.select("event_type", "event_count", _share(F.col("event_count"), 2).alias("percentage"), "revenue_contribution").orderBy(F.desc("event_count"), "event_type")


def peak_hours(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    g = _recent(cube, "minute", as_of, 720).groupBy(F.hour("minute").cast("bigint").alias("hour_of_day")).agg(F.count_distinct(F.to_date("minute")).alias("days_in_sample"), F.sum("events").alias("total_events_30d"))
    down = Window.orderBy(F.desc("total_events_30d"), "hour_of_day").rowsBetween(Window.unboundedPreceding, 0)  # 24 rows
    return g.select(
        "hour_of_day", "days_in_sample", "total_events_30d", rounded(ratio(F.col("total_events_30d"), F.col("days_in_sample")), 0).alias("avg_events_per_day_at_hour"),
        F.max("total_events_30d").over(down).alias("running_max"), _share(F.col("total_events_30d"), 2).alias("pct_of_daily_traffic"),
    ).orderBy(F.desc("total_events_30d"), "hour_of_day")


def category_leaderboard(cube: DataFrame, as_of: datetime.datetime) -> DataFrame:
    kinds = {"views": "VIEW", "add_to_carts": "ADD_TO_CART", "orders": "ORDER_CREATED", "payments": "PAYMENT_SUCCESS", "_refunds": "REFUND"}
    g = _recent(cube, "minute", as_of, 168).groupBy(_label()).agg(
        F.sum("events").alias("total_events"), *[_of("events", t).alias(n) for n, t in kinds.items()], F.count_distinct("user_id").alias("unique_shoppers"), cents(_of("revenue", "PAYMENT_SUCCESS")).alias("gross_revenue")
    )
    pct = lambda a, b: rounded(100.0 * ratio(F.col(a), F.col(b)))
    return g.select(
        "category", "total_events", "views", "add_to_carts", "orders", "payments", "unique_shoppers", "gross_revenue", pct("add_to_carts", "views").alias("view_to_cart_pct"),
        pct("orders", "add_to_carts").alias("cart_to_order_pct"), pct("payments", "orders").alias("order_to_payment_pct"), pct("payments", "views").alias("overall_conversion_pct"),
        rounded(ratio(F.col("gross_revenue"), F.col("payments"))).alias("avg_order_value"), pct("_refunds", "payments").alias("refund_rate_pct"),
    ).orderBy(F.desc("gross_revenue"), "category")


def minute_rollup_top20(cube: DataFrame, as_of: datetime.datetime, hours: float = 1) -> DataFrame:
    g = _recent(cube, "minute", as_of, hours).groupBy("minute", "event_type", "category").agg(
        F.sum("events").alias("event_count"), F.sum("qty").alias("total_qty"), cents(F.sum("revenue")).alias("total_revenue"), F.count_distinct("user_id").alias("approx_users")
    )
    return g.orderBy(F.desc("minute"), F.desc("event_count"), "event_type", F.asc_nulls_last("category")).limit(20)


def kpi_latest(kpi: DataFrame, as_of: datetime.datetime, limit: int = 50) -> DataFrame:
    k = kpi.where(F.col("window_start") >= F.date_trunc("MINUTE", F.lit(as_of)) - F.expr("INTERVAL 1 HOUR"))
    return k.orderBy(F.desc("window_start"), F.desc("total_revenue"), "event_type", F.asc_nulls_last("category")).limit(limit)


def funnel_latest(funnel: DataFrame, as_of: datetime.datetime, hours: float = 6) -> DataFrame:
    return _recent(funnel, "window_start", as_of, hours).orderBy(F.desc("window_start"), F.desc("revenue"), F.asc_nulls_last("category"))


def realtime_kpis(events: DataFrame, as_of: datetime.datetime, hours: float = 24) -> DataFrame:
    paid, cart = F.col("event_type") == "PAYMENT_SUCCESS", F.col("event_type") == "ADD_TO_CART"
    g = _recent(events, "event_time", as_of, hours).agg(
        F.coalesce(cents(F.sum(F.when(paid, F.col("price")))), F.lit(0.0)).alias("revenue"), F.count_distinct(F.when(paid, F.col("event_id"))).alias("orders"), F.count_distinct("user_id").alias("active_users"),
        F.count_distinct(F.when(paid, F.col("user_id"))).alias("_payers"), F.count_distinct(F.when(cart, F.col("user_id"))).alias("_carters"),
    )
    zero = F.lit(0.0)
    return g.select("revenue", "orders", "active_users", F.coalesce(ratio(F.col("revenue"), F.col("orders")), zero).alias("avg_order_value"), F.coalesce(ratio(F.col("_payers"), F.col("_carters")), zero).alias("cart_conversion_rate"))


def revenue_timeseries(events: DataFrame, as_of: datetime.datetime, window: str = "24h", granularity: str = "5m") -> DataFrame:
    """Unknown tokens stand for 24h and 5m. A bucket with events but no payment is there, with 0."""
    hours, width = WINDOW_HOURS.get(window, 24), GRANULARITY.get(granularity, "5 minutes")
    paid = F.when(F.col("event_type") == "PAYMENT_SUCCESS", F.col("price"))
    return _recent(events, "event_time", as_of, hours).groupBy(bucket(F.col("event_time"), width).alias("bucket")).agg(F.coalesce(cents(F.sum(paid)), F.lit(0.0)).alias("revenue")).orderBy("bucket")


def funnel(events: DataFrame, as_of: datetime.datetime, period: str = "24h", group_by: str = "category", limit: int = 20, sort: str = "views") -> DataFrame:
    """The `limit` groups with the most of a measure of the user's choice (views where there is no such measure; nulls last)."""
    column = group_by if group_by in GROUPS else "category"
    t = F.col("event_type")
    kinds = {"views": "VIEW", "carts": "ADD_TO_CART", "orders": "ORDER_CREATED", "payments": "PAYMENT_SUCCESS"}
    source = events.withColumn("_group", F.col(column))
    g = _recent(source, "event_time", as_of, period_hours(period)).groupBy(F.col("_group").alias(column)).agg(*[F.count_if(t == k).alias(n) for n, k in kinds.items()])
    return g.withColumn("conversion_rate", rounded(ratio(F.col("payments"), F.col("views")), 4)).orderBy(F.desc_nulls_last(sort if sort in (*kinds, "conversion_rate") else "views"), F.asc_nulls_last(column)).limit(limit)


def global_funnel(groups: DataFrame) -> DataFrame:
    names = ("views", "carts", "orders", "payments")
    total = groups.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    rate = lambda a, b: F.coalesce(ratio(F.col(a), F.col(b)), F.lit(0.0))
    return total.select(*names, rate("carts", "views").alias("cart_rate"), rate("orders", "carts").alias("order_rate"), rate("payments", "orders").alias("payment_rate"), rate("payments", "views").alias("overall_rate"))


def top5_categories(groups: DataFrame) -> DataFrame:
    first = groups.orderBy(F.desc("views"), F.asc_nulls_last("category")).limit(5)
    return first.select(F.substring(F.coalesce("category", F.lit(NO_CATEGORY)), 1, 12).alias("category"), "views", "payments").orderBy(F.desc("payments"), "category")


def top_products(events: DataFrame, as_of: datetime.datetime, period: str = "7d", limit: int = 10) -> DataFrame:
    if not 1 <= limit <= 50:
        raise ValueError("limit must be 1 to 50")
    paid = _recent(events, "event_time", as_of, period_hours(period)).where((F.col("event_type") == "PAYMENT_SUCCESS") & (F.col("product_id") != ""))
    g = paid.groupBy("product_id").agg(cents(F.sum("price")).alias("revenue"), F.count(F.lit(1)).alias("units_sold"), F.count("price").alias("_priced"))
    return g.select("product_id", "revenue", "units_sold", rounded(ratio(F.col("revenue"), F.col("_priced"))).alias("avg_price")).orderBy(F.desc("revenue"), "product_id").limit(limit)


def live_events(events: DataFrame, limit: int = 100) -> DataFrame:
    if not 1 <= limit <= 500:
        raise ValueError("limit must be 1 to 500")
    last = events.orderBy(F.desc("event_time"), F.desc("event_id")).limit(limit)
    return last.select("event_id", "event_type", "user_id", "product_id", "price", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("timestamp"))


def events_by_type(events: DataFrame, as_of: datetime.datetime, seconds: int = 300) -> DataFrame:
    return events.where(F.col("event_time") > F.lit(as_of) - F.expr(f"INTERVAL {int(seconds)} SECONDS")).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def per_minute_by_type(cube: DataFrame, as_of: datetime.datetime, minutes: int = 10, limit: int = 20) -> DataFrame:
    g = _recent(cube, "minute", as_of, minutes / 60).groupBy("minute", "event_type").agg(F.sum("events").alias("events"), cents(F.sum("revenue")).alias("revenue"))
    return g.orderBy(F.desc("minute"), "event_type").limit(limit)


def user_days(events: DataFrame, user_id: str) -> DataFrame:
    return events.where(F.col("user_id") == user_id).groupBy(F.date_trunc("DAY", "event_time").alias("day")).agg(F.count(F.lit(1)).alias("events")).orderBy("day")


def timeseries(df: DataFrame, time: str, start: datetime.datetime, end: datetime.datetime, granularity: str, aggregations: dict[str, Column], where: Column | None = None, post: dict[str, Column] | None = None, descending: bool = False) -> DataFrame:
    """A native time-series query: aggregations per bucket of [start, end), then post-aggregations over their names."""
    rows = df.where((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    rows = rows if where is None else rows.where(where)
    g = rows.groupBy(bucket(F.col(time), GRANULARITY[granularity]).alias("timestamp")).agg(*[c.alias(n) for n, c in aggregations.items()])
    return g.withColumns(post or {}).orderBy(F.desc("timestamp") if descending else F.asc("timestamp"))
