"""Data-quality suite: all expectations in one aggregation, then a row for each."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scratch import stage
from tributary.schema import DEVICES, EVENT_TYPES


def expectations(now: datetime.datetime) -> list[tuple[str, str, Column, float, bool]]:
    """(name, column, predicate, least share that passes, whether nulls count): nulls are left out unless the check is for them."""
    c, at = F.col, F.lit(now)
    listed = lambda name: (f"{name}_not_null", name, c(name).isNotNull(), 1.0, True)
    return [
        listed("event_id"),
        ("event_id_length", "event_id", F.length("event_id") >= 8, 1.0, False),
        ("event_id_pattern", "event_id", c("event_id").rlike(r"^[0-9a-fA-F\-]{8,}$"), 1.0, False),
        listed("event_time"),
        ("event_time_recent", "event_time", (c("event_time") >= at - F.expr("INTERVAL 48 HOURS")) & (c("event_time") <= at + F.expr("INTERVAL 5 MINUTES")), 1.0, False),
        listed("session_id"),
        ("session_id_length", "session_id", F.length("session_id") >= 8, 1.0, False),
        listed("event_type"),
        ("event_type_in_set", "event_type", c("event_type").isin(*EVENT_TYPES), 1.0, False),
        listed("device"),
        ("device_in_set", "device", c("device").isin(*DEVICES), 1.0, False),
        ("price_not_negative", "price", c("price") >= 0, 0.99, False),
        ("quantity_in_range", "quantity", c("quantity").between(0, 10_000), 0.999, False),
        ("category_pattern", "category", c("category").rlike(r"^[a-z][a-z0-9_]*$"), 0.98, False),
        ("event_time_ordered", "event_time", c("event_time") >= c("event_time"), 1.0, False),
    ]


LEAST_ROWS = 4


def suite(events: DataFrame, now: datetime.datetime) -> DataFrame:
    """expectation, column, evaluated, passed, success: one row per expectation, in one pass over events."""
    checks = expectations(now)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, column, ok, _, nulls in checks:
        seen = F.count(F.lit(1)) if nulls else F.count(column)
        aggs += [seen.alias(f"{name}_n"), F.count_if(ok).alias(f"{name}_ok")]
    one = events.agg(*aggs)
    rows = [
        F.struct(F.lit(i).cast("int").alias("place"), F.lit(name).alias("expectation"), F.lit(column).alias("column"), F.col(f"{name}_n").alias("evaluated"), F.col(f"{name}_ok").alias("passed"), F.lit(share).alias("least_share"))
        for i, (name, column, _, share, _) in enumerate(checks)
    ]
    enough = F.when(F.col("rows") >= LEAST_ROWS, F.col("rows")).otherwise(F.lit(0).cast("bigint"))
    rows.append(F.struct(F.lit(len(checks)).cast("int").alias("place"), F.lit("row_count").alias("expectation"), F.lit("*").alias("column"), F.col("rows").alias("evaluated"), enough.alias("passed"), F.lit(1.0).alias("least_share")))
    out = one.select(F.inline(F.array(*rows)))
    success = F.when(F.col("expectation") == "row_count", F.col("passed") > 0).otherwise((F.col("evaluated") == 0) | (F.col("passed") / F.nullif(F.col("evaluated").cast("double"), F.lit(0.0)) >= F.col("least_share")))
    return out.select("place", "expectation", "column", "evaluated", "passed", success.alias("success")).orderBy("place")


#: Hours back that the suite looks, and rows that it looks at.
LOOKBACK_HOURS = 1
SAMPLE_ROWS = 10_000


def recent_sample(events: DataFrame, now: datetime.datetime, hours: float = LOOKBACK_HOURS, most: int = SAMPLE_ROWS) -> DataFrame:
    """The sample that the suite is run on: at most so many events of the last hours, evenly spaced by time and id."""
    return every_nth(events.where(F.col("event_time") >= F.lit(now) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")), most, ["event_time", "event_id"])


class QualityError(RuntimeError):
    """The suite has failed, and was to fail its run."""


def publish(result: DataFrame, table: str, ts: str, most_failures: int = 10, write: Callable[[dict], str] | None = None, alert: Callable[[str], None] | None = None, fail: bool = False) -> dict:
    """The suite's verdict, ready to be written as JSON or sent as an alert; result has a row per expectation.

    write stores the verdict and returns where (that it cannot is no failure of the suite); alert is sent a message if the
    suite has failed; with fail, QualityError is raised then, after both.
    """
    verdict = _verdict(result, table, ts, most_failures)
    if write is not None:
        try:
            verdict["stored"] = write(verdict)
        except Exception as e:
            verdict["stored"] = None
            verdict["store_error"] = str(e)[:500]
    if not verdict["suite_passed"]:
        said = f"quality suite failed on {table}: {verdict['failed']} of {verdict['expectations']} expectations, {verdict['row_count']} rows"
        if alert is not None:
            alert("\n".join([said, *[f"{d['expectation']} on {d['column']}: {d['result']}" for d in verdict["failed_details"]]]))
        if fail:
            raise QualityError(said)
    return verdict


def _verdict(result: DataFrame, table: str, ts: str, most_failures: int) -> dict:
    rows = result.collect()
    failed = [r for r in rows if not r["success"]]
    return {
        "suite_passed": not failed, "expectations": len(rows), "passed": len(rows) - len(failed), "failed": len(failed),
        "failed_details": [{"expectation": r["expectation"], "column": r["column"], "result": f"{r['passed']}/{r['evaluated']}"} for r in failed[:most_failures]],
        "row_count": next(r["evaluated"] for r in rows if r["expectation"] == "row_count"), "table": table, "ts": ts,
    }


def verdict_json(verdict: dict) -> str:
    return json.dumps(verdict, ensure_ascii=False)


def every_nth(rows: DataFrame, most: int, order: list[str]) -> DataFrame:
    """A sample of at most `most` rows, evenly spaced in the given order: every n-th, n = count div most, at least 1.

    Rows are numbered by range partitions and offsets, not by one task.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    parts = stage(parts, "placed")
    part = F.shiftright("_id", 33)
    sizes = parts.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = parts.withColumn("_p", part).join(sizes.withColumn("_before", before), "_p").withColumn("_row", F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    n = sizes.agg(F.sum("_n")).first()[0] or 0
    step = max(1, n // most)
    return numbered.where((F.col("_row") % step == 0) & (F.col("_row") < step * most)).select(*rows.columns)


def health(components: DataFrame) -> DataFrame:
    """components (name, status): healthy if all are up, unhealthy if any is down, else degraded."""
    up, down = F.coalesce(F.bool_and(F.col("status") == "up"), F.lit(True)), F.coalesce(F.bool_or(F.col("status") == "down"), F.lit(False))
    return components.agg(F.when(up, "healthy").when(down, "unhealthy").otherwise("degraded").alias("status"), F.count(F.lit(1)).alias("components"))


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The keys of expected, each once, that found does not have; nulls are left out."""
    return expected.select(key).where(F.col(key).isNotNull()).distinct().join(found, key, "left_anti")


def same_set(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows, however often."""
    b = b.select(*a.columns)
    return not a.subtract(b).limit(1).count() and not b.subtract(a).limit(1).count()
