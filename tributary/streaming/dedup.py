"""Deduplication within a time to live, as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tributary.functions.ship import ship

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    """Passes the first row of an id and drops others until its time to live is over.

    The state of an id is when it was first seen: the row's time (the clock where it has none), which expires by the processing-time clock from the write on.
    With extend_on_duplicate every repeat writes it again.
    """

    def __init__(self, ttl_ms: int, extend_on_duplicate: bool = False, time: str = "event_time") -> None:
        self.ttl_ms, self.extend, self.time = ttl_ms, extend_on_duplicate, time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("first_seen", "at timestamp", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, first = self.seen.exists(), None
        for batch in rows:
            if not len(batch):
                continue
            timed = batch[self.time].dropna()
            one = batch.loc[[timed.idxmin()]] if len(timed) else batch.iloc[[0]]
            at = one[self.time].iloc[0]
            if first is None or (not pd.isna(at) and (pd.isna(first[self.time].iloc[0]) or at < first[self.time].iloc[0])):
                first = one
        if first is None:
            return
        if not known or self.extend:
            at = first[self.time].iloc[0]
            self.seen.update((pd.Timestamp.now() if pd.isna(at) else at,))
        if not known:
            yield first

    def close(self) -> None:
        pass


def first_seen(events: DataFrame, ttl_hours: float = 2, extend_on_duplicate: bool = False, key: str = "event_id") -> DataFrame:
    """events without repeats of an id within `ttl_hours` of processing time. Needs the RocksDB state store.

    Rows without an id are one key here; send them past this operator, as with_id() splits them off.
    """
    if ttl_hours <= 0:
        raise ValueError("windowHours must be positive")
    ship(events.sparkSession)
    return events.groupBy(key).transformWithStateInPandas(
        statefulProcessor=FirstSeen(int(ttl_hours * 3_600_000), extend_on_duplicate), outputStructType=events.schema, outputMode="Append", timeMode="ProcessingTime"
    )


def durable(spark: SparkSession) -> None:
    """State in RocksDB, whose checkpoints are the changes since the last one."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def once(events: DataFrame, ttl_hours: float = 2, extend_on_duplicate: bool = False, key: str = "event_id") -> DataFrame:
    """Judged events (with `reason`) without repeats of valid ids within `ttl_hours` of processing time; all other rows pass.

    The watermark runs on the batches' clock, so however late an event is, it is kept if its id is new, and an id is
    forgotten `ttl_hours` after it was first seen. It stays in the JVM; only extend_on_duplicate takes a state function.
    """
    if ttl_hours <= 0:
        raise ValueError("windowHours must be positive")
    watched = F.col("reason").isNull() & F.col(key).isNotNull()
    if extend_on_duplicate:
        return first_seen(events.where(watched), ttl_hours, True, key).unionByName(events.where(~watched))
    # one pass for both: rows that are no one's repeats have a key of their own
    own = F.when(watched, F.concat(F.lit("id:"), F.col(key))).otherwise(F.concat(F.lit("row:"), F.expr("uuid()")))
    timed = events.withColumns({"_key": own, "_seen_at": F.current_timestamp()}).withWatermark("_seen_at", f"{max(1, int(ttl_hours * 3600))} seconds")
    return timed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_seen_at")


def within_watermark(events: DataFrame, delay: str = "2 hours", key: str = "event_id", time: str = "event_time") -> DataFrame:
    """The event-time form, which stays in the JVM: repeats within the watermark's delay of the first are dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def with_id(events: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rows without), the latter to be passed on as they are."""
    return events.where(F.col(key).isNotNull()), events.where(F.col(key).isNull())
