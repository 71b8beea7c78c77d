"""Synthetic events: shopping sessions by a state machine, and independent uniform events. The same seed gives the same events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.events import CATEGORIES, PAYMENT_MODES

STEPS = 24
#: Devices and how often they occur.
DEVICE_SHARES = (("web", 0.45), ("android", 0.35), ("ios", 0.20))


def _draw(seed: int, *keys: Column | str) -> Column:
    """A uniform number in [0, 1) that depends on nothing but the seed and the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _machine(seed: int, session: str = "session") -> Column:
    """The events of a session as an array of types, folded over steps; states: 0 browsing, 1 carted, 2 ordering, 3 done."""
    least = 1 + F.floor(_draw(seed, session, F.lit("views")) * 4).cast("int")
    kind = "struct<state:int,views:int,events:array<string>>"
    start = F.struct(F.lit(0).alias("state"), F.lit(0).alias("views"), F.array().cast("array<string>").alias("events"))

    def step(acc: Column, i: Column) -> Column:
        u, v = _draw(seed, session, i, F.lit("u")), _draw(seed, session, i, F.lit("v"))
        views = F.when(acc["state"] == 0, acc["views"] + 1).otherwise(acc["views"])
        browse = F.when(views < least, "VIEW").when(u < 0.60, "ADD_TO_CART").when(u < 0.75, "WISHLIST").otherwise("VIEW")
        carted = F.when(u < 0.70, "ORDER_CREATED").when(u < 0.85, "REMOVE_CART").otherwise("VIEW")
        ordering = F.when(u < 0.80, "PAYMENT_SUCCESS").when(v < 0.30, "ORDER_CANCELLED").otherwise("PAYMENT_FAILED")
        event = F.when(acc["state"] == 0, browse).when(acc["state"] == 1, carted).otherwise(ordering)
        after = F.when(acc["state"] == 2, 3).when(event == "ADD_TO_CART", 1).when(event == "ORDER_CREATED", 2).when(event == "REMOVE_CART", 3).otherwise(acc["state"])
        on = F.struct(after.cast("int").alias("state"), views.cast("int").alias("views"), F.concat(acc["events"], F.array(event)).alias("events"))
        return F.when(acc["state"] == 3, acc).otherwise(on).cast(kind)

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start.cast(kind), step)["events"]


def _device(u: Column) -> Column:
    out, below = F.when(F.lit(False), ""), 0.0
    for name, share in DEVICE_SHARES:
        below += share
        out = out.when(u < below, name)
    return out.otherwise(DEVICE_SHARES[-1][0])


def sessions(spark: SparkSession, n: int, seed: int = 0, start: str = "2024-01-01 00:00:00") -> DataFrame:
    """Events of n sessions, about one a second from `start`; 30 % of sessions are anonymous. A session without an end stops after STEPS events."""
    s = spark.range(n).withColumnRenamed("id", "session")
    e = s.select("session", F.posexplode(_machine(seed)).alias("place", "event_type"))
    u = lambda *keys: _draw(seed, "session", *[F.lit(k) if isinstance(k, str) else k for k in keys])
    sku, place = F.floor(u("sku") * 100).cast("int"), F.col("place")
    priced = F.col("event_type").isin("ADD_TO_CART", "ORDER_CREATED", "PAYMENT_SUCCESS")
    counted = F.col("event_type").isin("ADD_TO_CART", "ORDER_CREATED")
    pays = F.col("event_type").isin("ORDER_CREATED", "PAYMENT_SUCCESS", "PAYMENT_FAILED")
    name = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.call_function("div", sku, F.lit(10)) + 1).cast("int"))
    return e.select(
        F.md5(F.concat_ws("-", F.lit(str(seed)), "session", "place")).alias("event_id"), F.concat(F.lit("sess-"), F.col("session").cast("string")).alias("session_id"),
        (F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("session") + place * 30).cast("decimal(18,6)"))).alias("event_time"),
        "event_type", _device(u("device")).alias("device"), F.concat(F.lit("203.0.113."), (F.col("session") % 256).cast("string")).alias("ip"),
        F.when(u("anonymous") >= 0.3, F.concat(F.lit("USR-"), F.lpad(F.floor(u("user") * 10_000).cast("string"), 5, "0"))).alias("user_id"),
        F.concat(F.lit("SKU-"), sku.cast("string")).alias("product_id"), name.alias("category"), F.when(counted, 1 + F.floor(u("qty") * 3)).cast("int").alias("quantity"),
        F.when(priced, F.round(10 + u("price") * 990, 2)).alias("price"), F.when(pays, F.element_at(F.array(*[F.lit(m) for m in PAYMENT_MODES]), (F.floor(u("mode") * len(PAYMENT_MODES)) + 1).cast("int"))).alias("payment_mode"),
    )


def uniform(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """Independent events of eight types, 5 % of them anonymous."""
    kinds = ("VIEW", "ADD_TO_CART", "WISHLIST", "ORDER_CREATED", "ORDER_CANCELLED", "PAYMENT_SUCCESS", "PAYMENT_FAILED", "REFUND")
    e = spark.range(n)
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.floor(_draw(seed, "id", F.lit("kind")) * 8) + 1).cast("int"))
    return e.select(
        F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string"))).alias("event_id"), kind.alias("event_type"), F.when(_draw(seed, "id", F.lit("user")) >= 0.05, F.concat(F.lit("USR-"), (F.col("id") % 10_000).cast("string"))).alias("user_id"),
        F.round(_draw(seed, "id", F.lit("price")) * 1000, 2).alias("price"),
    )


def rate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """A rate-limited stream of (timestamp, value)."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
