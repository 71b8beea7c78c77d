"""Removing repeated events in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_id(events: DataFrame, key: str = "event_id", order: str = "event_time") -> DataFrame:
    """The earliest row of each id (of several, the one whose columns have the least hash); rows without an id all stay. The same as first_seen() where repeats lie within one time to live."""
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())  # rows without an id are no one's repeats, nor gathered
    w = Window.partitionBy(key, "_alone").orderBy(order, F.xxhash64(*events.columns))
    return events.withColumn("_alone", alone).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_alone")


def first_seen(events: DataFrame, ttl_hours: float = 2, extend_on_duplicate: bool = False, key: str = "event_id", order: str = "event_time") -> DataFrame:
    """Rows that are not within `ttl_hours` of the last row kept of their id (of the last row at all with extend_on_duplicate).

    An id whose rows all lie within the time keeps its first: that settles nearly all of them by a least and a greatest, which
    are combined before the shuffle. Times of the others are cut where the gap to the one before is no shorter than the time
    to live, since a row after such a gap is kept whatever came before; only the stretches between are folded, as arrays.
    Repeats at the same time count once. Rows without an id all stay.
    """
    if ttl_hours <= 0:
        raise ValueError("windowHours must be positive")
    ttl = int(ttl_hours * 3_600_000_000)
    at = F.unix_micros(order)
    keyed = events.where(F.col(key).isNotNull())
    others = events.where(F.col(key).isNull())
    gap = F.col("_at") - F.lag("_at").over(Window.partitionBy(key).orderBy("_at"))
    if extend_on_duplicate:
        kept = keyed.withColumn("_at", at).withColumn("_gap", gap).where(F.col("_gap").isNull() | (F.col("_gap") >= ttl)).drop("_at", "_gap")
        return kept.unionByName(others)

    def step(seen: Column, t: Column) -> Column:
        return F.when((F.size(seen) == 0) | (t - F.element_at(seen, -1) >= ttl), F.concat(seen, F.array(t))).otherwise(seen)

    bounds = keyed.groupBy(key).agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    once = bounds.where(F.col("_last") - F.col("_first") < ttl).select(key, F.col("_first").alias("_at"))
    long = bounds.where(F.col("_last") - F.col("_first") >= ttl).select(key)
    times = keyed.select(key, at.alias("_at")).join(long, key, "left_semi").distinct().withColumn("_gap", gap)
    begins = F.col("_gap").isNull() | (F.col("_gap") >= ttl)
    times = times.withColumn("_stretch", F.max(F.when(begins, F.col("_at"))).over(Window.partitionBy(key).orderBy("_at")))
    folded = times.groupBy(key, "_stretch").agg(F.array_sort(F.collect_list("_at")).alias("_times"))
    kept = folded.select(key, F.explode(F.aggregate("_times", F.array().cast("array<bigint>"), step)).alias("_at")).unionByName(once)
    one = keyed.withColumn("_at", at).withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_at").orderBy(F.xxhash64(*events.columns)))).where("_rn = 1").drop("_rn")
    return one.join(kept, [key, "_at"], "left_semi").select(*events.columns).unionByName(others)


def latest_version(rows: DataFrame, key: tuple[str, ...] = ("event_type", "category", "event_time", "event_id"), version: str = "ingest_ts") -> DataFrame:
    """The row with the latest version of each key (of several, the one whose columns have the least hash); a null is a key like any other."""
    w = Window.partitionBy(*key).orderBy(F.col(version).desc(), F.xxhash64(*rows.columns))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(table: DataFrame, rows: DataFrame, key: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """table with rows put in the place of those under the same keys; of equal keys in rows one stays."""
    fresh = rows.dropDuplicates(list(key))
    return table.join(fresh.select(*key), list(key), "left_anti").unionByName(fresh)


def correlate(sent: DataFrame, received: DataFrame, key: str = "event_id", within_seconds: float = 300) -> DataFrame:
    """Latency of events that were sent (sent_at) and received (received_at) within a time: key, latency_ms."""
    pair = sent.select(key, "sent_at").join(received.select(key, "received_at"), key)
    ms = (F.unix_micros("received_at") - F.unix_micros("sent_at")) / 1000.0
    return pair.select(key, ms.alias("latency_ms")).where((F.col("latency_ms") > 0) & (F.col("latency_ms") < within_seconds * 1000))
