"""Rollups as mergeable partial aggregates: what one batch contributes, and how contributions are merged on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.expr import bucket, cents, ntz, ratio, rounded

DIMENSIONS = ("event_type", "category", "payment_mode", "device")


def amount() -> Column:
    """price times quantity, where a missing one counts as 0 rather than dropping the row."""
    return F.coalesce(F.col("price"), F.lit(0.0)) * F.coalesce(F.col("quantity"), F.lit(0)).cast("double")


def measures(events: DataFrame) -> DataFrame:
    """Each event as a rollup of itself, for queries to run over either events or a stored rollup."""
    return events.select(
        F.date_trunc("MINUTE", "event_time").alias("minute"), *DIMENSIONS, F.lit(1).cast("bigint").alias("events"), F.coalesce("quantity", F.lit(0)).cast("bigint").alias("qty"),
        F.coalesce("price", F.lit(0.0)).alias("revenue"), "user_id",
    )


def rollup_1min(events: DataFrame, sketch: bool = False) -> DataFrame:
    """Events per minute and dimensions (null is a group of its own); with sketch also a HyperLogLog state of users."""
    aggs = [F.sum("events").alias("events"), F.sum("qty").alias("qty"), cents(F.sum("revenue")).alias("revenue")]
    if sketch:
        aggs.append(F.hll_sketch_agg("user_id", 12).alias("uniq_users"))
    return measures(events).groupBy("minute", *DIMENSIONS).agg(*aggs)


def merge_rollup(partials: DataFrame) -> DataFrame:
    aggs = [F.sum("events").alias("events"), F.sum("qty").alias("qty"), cents(F.sum("revenue")).alias("revenue")]
    if "uniq_users" in partials.columns:
        aggs.append(F.hll_union_agg("uniq_users").alias("uniq_users"))
    return partials.groupBy("minute", *DIMENSIONS).agg(*aggs)


def kpi_partials(events: DataFrame) -> DataFrame:
    """One batch's share of the minute KPIs; users are kept as distinct values, one row each, so that no state is unbounded.

    user_id is null in the row that carries the sums of the users' anonymous events.
    """
    keys = [bucket(F.col("event_time"), "1 minute").alias("window_start"), "category", "event_type", "user_id"]
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum(F.coalesce("quantity", F.lit(0)).cast("double")).alias("qty"), F.sum(amount()).alias("revenue")
    )


def kpi_1min(partials: DataFrame) -> DataFrame:
    """Partials of any number of batches, merged."""
    users = partials.groupBy("window_start", "category", "event_type", "user_id").agg(F.sum("event_count").alias("n"), F.sum("qty").alias("q"), F.sum("revenue").alias("r"))
    return users.groupBy("window_start", "category", "event_type").agg(
        F.sum("n").alias("events"), F.sum("q").alias("total_qty"), cents(F.sum("r")).alias("total_revenue"), F.count("user_id").alias("unique_users")
    )


def funnel_partials(events: DataFrame) -> DataFrame:
    t = F.col("event_type")
    return events.groupBy(bucket(F.col("event_time"), "5 minutes").alias("window_start"), "category").agg(
        F.count_if(t == "VIEW").alias("views"), F.count_if(t == "ADD_TO_CART").alias("carts"), F.count_if(t == "ORDER_CREATED").alias("orders"),
        F.count_if(t == "PAYMENT_SUCCESS").alias("payments"), F.sum(F.when(t == "PAYMENT_SUCCESS", amount()).otherwise(0.0)).alias("revenue"),
    )


def funnel_5min(partials: DataFrame) -> DataFrame:
    counts = ("views", "carts", "orders", "payments")
    merged = partials.groupBy("window_start", "category").agg(*[F.sum(c).alias(c) for c in counts], cents(F.sum("revenue")).alias("revenue"))
    rate = lambda a, b: rounded(ratio(F.col(a), F.col(b)) * 100.0)
    return merged.select(
        "window_start", "category", *counts, "revenue", rate("carts", "views").alias("view_to_cart_pct"), rate("orders", "carts").alias("cart_to_order_pct"),
        rate("payments", "orders").alias("order_to_pay_pct"), rate("payments", "views").alias("overall_cvr_pct"),
    )


def hourly_category(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("HOUR", "event_time").alias("hour"), "category").agg(F.count(F.lit(1)).alias("events"), cents(F.sum(F.coalesce("price", F.lit(0.0)))).alias("revenue"))


def plain_times(df: DataFrame) -> DataFrame:
    """All time stamps without a zone, as engines without zones show them."""
    return df.withColumns({f: ntz(F.col(f)) for f, kind in df.dtypes if kind == "timestamp"})
