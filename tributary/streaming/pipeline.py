"""The stream job: raw events to stored events, dead letters and partial aggregates, each batch written once whatever is replayed."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.functions.files import Files
from tributary.operators import clean as C
from tributary.operators.dedup import first_per_id
from tributary.plans import rollup as R
from tributary.streaming import dedup as D
from tributary.streaming.store import Store

#: Seconds between batches and between the store's flushes.
TRIGGER_SECONDS = 30
FLUSH_SECONDS = 7.5
#: Hours that an event's id is remembered.
DEDUP_HOURS = 2.0
#: What is kept of events beside themselves, each as partial aggregates of a batch: how they are made, and the column of their time.
PARTIALS: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {"kpi_1min": (R.kpi_partials, "window_start"), "funnel_5min": (R.funnel_partials, "window_start"), "rollup_1min": (lambda e: R.rollup_1min(e, sketch=True), "minute")}


def dated(df: DataFrame, time: str) -> DataFrame:
    """With the date that tables are partitioned by."""
    return df.withColumn("event_date", F.to_date(time))


def ingest(tagged: DataFrame, batch_id: int, store: Store, writer: str = "ingest") -> int:
    """One block: storage, dead letters, minute KPIs, funnels and minute rollups from the same rows, visible at once and under one batch id.

    tagged are raw events with the reason for which they are rejected, if any. A batch that is run again changes nothing.
    """
    raw = [c for c in tagged.columns if c not in ("reason", "event_date")]
    tagged = tagged.persist()
    try:
        good = C.normalised(tagged.where("reason is null").drop("reason")).withColumn("ingest_ts", F.current_timestamp())
        bad = tagged.where("reason is not null").select("reason", F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}).alias("raw_payload"), F.unix_millis(F.current_timestamp()).alias("ingest_ts"))
        tables = {"events": (dated(good, "event_time"), "event_date"), "dead_letters": (bad, None)}
        tables |= {name: (dated(partials(good), time), "event_date") for name, (partials, time) in PARTIALS.items()}
        written = {name: store.write(df, name, column) for name, (df, column) in tables.items()}
        return store.commit({n: e for n, (e, _) in written.items()}, schemas={n: s for n, (_, s) in written.items()}, writer=writer, batch=batch_id)
    finally:
        tagged.unpersist()


def judged(events: DataFrame, now: datetime.datetime | None = None, max_skew_hours: float | None = 48) -> DataFrame:
    """Raw events of a stream with the reason for which they are rejected. Without `now` each batch is judged by its own clock."""
    return events.withColumn("reason", C.reason(now, max_skew_hours))


def start(
    events: DataFrame, store: Store, checkpoint: str, name: str = "tributary-ingest", now: datetime.datetime | None = None, max_skew_hours: float | None = 48, available_now: bool = False,
    dedup_hours: float | None = DEDUP_HOURS, extend_on_duplicate: bool = False,
) -> StreamingQuery:
    """Starts the job: validation, then removal of repeats among valid events, then the sinks.

    `now` judges freshness; by default each batch is judged by its own clock. Repeats of an id within `dedup_hours` of
    processing time go (None: all stay); rejected events are no one's repeats. State is kept in RocksDB with changelogs.
    """
    D.durable(events.sparkSession)
    rows = judged(events, now, max_skew_hours)
    if dedup_hours is not None:
        rows = D.once(rows, dedup_hours, extend_on_duplicate)
    files, writer = Files(events.sparkSession, checkpoint), []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not writer:  # the query's own id, which a new checkpoint has a new one of
            writer.append(json.loads(files.read("metadata").splitlines()[-1])["id"])
        ingest(batch, batch_id, store, writer[0])

    out = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    out = out.trigger(availableNow=True) if available_now else out.trigger(processingTime=f"{TRIGGER_SECONDS} seconds")
    return out.start()


def kpi_view(store: Store, since: datetime.date | None = None) -> DataFrame:
    """The minute KPIs as of all batches so far: partials are merged on read."""
    return R.kpi_1min(store.read("kpi_1min", since=since))


def funnel_view(store: Store, since: datetime.date | None = None) -> DataFrame:
    return R.funnel_5min(store.read("funnel_5min", since=since))


def rollup_view(store: Store, since: datetime.date | None = None) -> DataFrame:
    return R.merge_rollup(store.read("rollup_1min", since=since))


def rebuild(store: Store) -> None:
    """Replaces the partials by those of the deduplicated events, after repeats across batches have inflated them.

    It is done for the events of one version; partials of batches that come in the meantime stay beside the new ones.
    """
    state = store.state()
    once = first_per_id(store.read("events", state["version"]).drop("event_date")).persist()
    try:
        for name, (partials, time) in PARTIALS.items():
            store.replace(dated(partials(once), time), name, [e["path"] for e in state["tables"].get(name, [])], "event_date")
    finally:
        once.unpersist()


def windowed(events: DataFrame, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Counts and revenue per tumbling window, category and type, for sinks that take updates."""
    e = events.withWatermark("event_time", delay)
    return e.groupBy(F.window("event_time", width), "category", "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum(R.amount()).alias("revenue"))


def latency(sent: DataFrame, received: DataFrame, within: str = "5 minutes") -> DataFrame:
    """Streams of (event_id, sent_at) and (event_id, received_at) to latencies; events that are not matched in time leave the state."""
    a, b = sent.withWatermark("sent_at", within).alias("a"), received.withWatermark("received_at", within).alias("b")
    on = F.expr(f"a.event_id = b.event_id and b.received_at > a.sent_at and b.received_at < a.sent_at + interval {within}")
    return a.join(b, on).select(F.col("a.event_id").alias("event_id"), ((F.unix_micros("received_at") - F.unix_micros("sent_at")) / 1000.0).alias("latency_ms"))


def job_summary(query: StreamingQuery, store: Store | None = None, now: datetime.datetime | None = None) -> dict:
    """Rows, rate and last batch of a query, hours since the first of its known batches, and its last checkpoint: batch, when, how long it took to write."""
    last, known = query.lastProgress or {}, query.recentProgress
    moment = lambda p: datetime.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00"))
    at = now or datetime.datetime.now(datetime.UTC)
    took = last.get("durationMs", {})
    return {
        "id": str(query.id), "name": query.name, "active": query.isActive, "batch": last.get("batchId"), "input_rows": last.get("numInputRows", 0), "records": sum(p["numInputRows"] for p in known),
        "rows_per_second": last.get("processedRowsPerSecond", 0.0), "ended": last.get("timestamp"), "uptime_hours": round((at - moment(known[0])).total_seconds() / 3600, 3) if known else 0.0,
        "last_checkpoint": {"batch": last.get("batchId"), "at": last.get("timestamp"), "duration_ms": took.get("commitOffsets", 0) + took.get("walCommit", 0)} if last else None,
        "version": store.state()["version"] if store else None,
    }


class FanOut:
    """Hands events to at most `most` clients as JSON strings; a client that takes longer than `patience` seconds, or fails, is dropped. Without clients nothing is decoded."""

    def __init__(self, most: int = 50, patience: float = 2.0) -> None:
        self.most, self.patience, self.clients = most, patience, {}
        self.sent = self.dropped = 0

    def connect(self, name: str, send: Callable[[list[str]], None]) -> bool:
        """False if there are enough clients already."""
        if len(self.clients) >= self.most:
            return False
        self.clients[name] = send
        return True

    def disconnect(self, name: str) -> None:
        self.clients.pop(name, None)

    def send(self, values: list[str]) -> None:
        from concurrent.futures import ThreadPoolExecutor, wait

        clients = dict(self.clients)
        pool = ThreadPoolExecutor(max(1, len(clients)))
        tasks = {pool.submit(send, values): name for name, send in clients.items()}
        wait(tasks, timeout=self.patience)
        for task, name in tasks.items():
            if not task.done() or task.exception() is not None:
                self.disconnect(name)
                self.dropped += 1
        pool.shutdown(wait=False, cancel_futures=True)
        self.sent += len(values)


def live(events: DataFrame, clients: FanOut | Callable[[list[str]], None], name: str = "live", limit: int = 200) -> StreamingQuery:
    """Hands each batch's newest events to clients as JSON strings; while there are none, batches pass unread."""

    def each(batch: DataFrame, _: int) -> None:
        if isinstance(clients, FanOut) and not clients.clients:
            return
        send = clients.send if isinstance(clients, FanOut) else clients
        send([r["value"] for r in batch.orderBy(F.desc("event_time")).limit(limit).select(F.to_json(F.struct("*")).alias("value")).collect()])

    return events.writeStream.queryName(name).foreachBatch(each).start()
