"""Validation and normalisation. Rules are tried in order and the first that fails is the only reason."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.expr import blank, strip

#: Device names by what they are counted as.
DEVICE_NAMES = {
    "web": ("web", "browser", "desktop", "pwa"),
    "android": ("android", "android_app"),
    "ios": ("ios", "iphone", "ipad", "ios_app"),
}
_STRIPPED = ("event_id", "session_id", "user_id", "product_id", "ip", "payment_mode")


def device(c: Column) -> Column:
    """web, android, ios or other; null is other."""
    name, out = F.lower(strip(c)), None
    for to, names in DEVICE_NAMES.items():
        out = F.when(name.isin(*names), to) if out is None else out.when(name.isin(*names), to)
    return out.otherwise("other")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def reason(now: datetime.datetime | None = None, max_skew_hours: float | None = None) -> Column:
    """Why a raw event is rejected, or null. now is a parameter, so a batch is judged by one instant (by default when its query begins); without max_skew_hours any time will do."""
    c = F.col
    missing = lambda name: F.lit(f"missing required field: {name}")
    out = (
        F.when(blank(c("event_id")), missing("event_id"))
        .when(blank(c("session_id")), missing("session_id"))
        .when(c("event_type").isNull(), missing("event_type"))
        .when(blank(c("device")), missing("device"))
        .when(blank(c("ip")), missing("ip"))
        .when(c("event_time").isNull(), missing("event_time"))
        .when(c("quantity") < 0, F.concat(F.lit("quantity must be >= 0, got: "), c("quantity").cast("string")))
        .when(c("price") < 0, F.concat(F.lit("price must be >= 0, got: "), c("price").cast("string")))
    )
    if max_skew_hours is not None:
        at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
        apart = F.abs(F.unix_millis(at) - F.unix_millis(c("event_time")))
        said = F.concat(F.lit(f"event_time out of ±{max_skew_hours:g}h window: "), iso(c("event_time")), F.lit(" (now="), iso(at), F.lit(")"))
        out = out.when(apart > int(max_skew_hours * 3_600_000), said)
    return out


def tagged(raw: DataFrame, now: datetime.datetime | None = None, max_skew_hours: float | None = None) -> DataFrame:
    """raw with a column `reason`: one pass from which both outputs are filtered."""
    return raw.withColumn("reason", reason(now, max_skew_hours))


def normalised(valid: DataFrame) -> DataFrame:
    out = valid.withColumns({name: strip(F.col(name)) for name in _STRIPPED})
    return out.withColumns({"category": F.lower(strip(F.col("category"))), "device": device(F.col("device"))})


def clean(raw: DataFrame, now: datetime.datetime | None = None, max_skew_hours: float | None = None) -> DataFrame:
    """Valid events, normalised."""
    return normalised(tagged(raw, now, max_skew_hours).where(F.col("reason").isNull()).drop("reason"))


def dead_letters(raw: DataFrame, ingest_ms: Column, now: datetime.datetime | None = None, max_skew_hours: float | None = None, layout: str = "full") -> DataFrame:
    """Rejected events: reason, raw_payload (JSON, nulls kept), ingest_ts; the `compact` layout has event_id in place of the payload."""
    bad = tagged(raw, now, max_skew_hours).where(F.col("reason").isNotNull())
    if layout == "compact":
        return bad.select("reason", "event_id", ingest_ms.alias("ingest_ts"))
    payload = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    return bad.select("reason", payload.alias("raw_payload"), ingest_ms.alias("ingest_ts"))


def envelope(letters: DataFrame) -> DataFrame:
    """Dead letters as one JSON string each."""
    payload = F.from_json("raw_payload", "map<string,string>")
    return letters.select(F.to_json(F.struct("reason", payload.alias("raw_payload"), "ingest_ts"), {"ignoreNullFields": "false"}).alias("value"))
