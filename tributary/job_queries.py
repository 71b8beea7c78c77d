"""Registered queries over what the jobs write: each runs its job over all events, into a folder of its own, and reads what is there."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import expr
from tributary.functions.scratch import scratch, stage
from tributary.functions.ship import ship
from tributary.operators import dedup as D
from tributary.operators import erasure, maintenance, quality
from tributary.registry import query
from tributary.schema import EVENT
from tributary.sources import sinks
from tributary.sources.events import AVRO_FIELDS, METRICS, as_of, decode, event_stream, metrics_csv, purge_errors, raw_events, store_errors, table, write_avro
from tributary.sources.generator import STEPS, sessions, uniform
from tributary.streaming import pipeline
from tributary.streaming.store import Store


def job(spark: SparkSession, sf_dir: str, batches: int = 1, **settings) -> Store:
    """The store after the stream job has read all raw events: each event first, in some batches, and then, in a batch of their own, those that are sent again."""
    at = scratch(spark, "job")
    raw = stage(raw_events(spark, sf_dir).withColumn("_nth", F.row_number().over(Window.partitionBy("event_id").orderBy("event_time"))), "raw")
    raw.where("_nth = 1").drop("_nth").repartition(batches).write.parquet(f"{at}/in")
    raw.where("_nth > 1").drop("_nth").coalesce(1).write.mode("append").parquet(f"{at}/in")
    store = Store(spark, f"{at}/store")
    pipeline.start(event_stream(spark, f"{at}/in", 1), store, f"{at}/cp", max_skew_hours=None, available_now=True, **settings).awaitTermination()
    return store


@query
def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What validation, removal of repeats and storage leave."""
    return job(spark, sf_dir).read("events").select(*[f.name for f in EVENT])


@query
def job_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = job(spark, sf_dir).read("dead_letters")
    return letters.select("reason", F.get_json_object("raw_payload", "$.event_id").alias("event_id"))


@query
def job_kpi_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.kpi_view(job(spark, sf_dir))


@query
def job_funnel_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.funnel_view(job(spark, sf_dir))


@query
def job_rollup_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.rollup_view(job(spark, sf_dir)).drop("uniq_users")


@query
def job_rebuilt_kpi_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats have inflated the partials, and a rebuild has taken them out."""
    store = job(spark, sf_dir, dedup_hours=None)
    pipeline.rebuild(store)
    return pipeline.kpi_view(store)


@query
def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events after their small files have been packed, older versions have expired, and their files have gone."""
    store = job(spark, sf_dir)
    store.compact("events")
    store.expire(days=0)
    return store.read("events").select(*[f.name for f in EVENT])


@query
def retained_kpi_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute KPIs of the partitions that are within ten days of the last event."""
    store = job(spark, sf_dir)
    store.purge("kpi_1min", as_of(spark, sf_dir).date(), 10)
    return pipeline.kpi_view(store)


@query
def store_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and warnings of each table."""
    store = job(spark, sf_dir)
    said = [(t, s["rows"], ",".join(s["warnings"])) for t in ("events", "dead_letters") for s in [store.stats(t)]]
    return spark.createDataFrame(said, "table string, rows long, warnings string")


@query
def erased_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a store when a user has been erased from it, and what the audit says."""
    store = job(spark, sf_dir)
    old = lambda: [e["path"] for e in store.state()["tables"]["events"]]
    audit = erasure.erase("USR-00007", {"events": (lambda: store.read("events"), lambda df: store.replace(df, "events", old(), "event_date"))})
    said = audit["systems_erased"]["events"]
    return store.read("events").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("user_id") == "USR-00007").alias("of_user")).withColumns({"status": F.lit(audit["status"]), "rows_deleted": F.lit(said["rows_deleted"]).cast("bigint")})


@query
def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table after two writes; the second corrects rows of the first."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type", "value")
    t = maintenance.SnapshotTable(spark, scratch(spark, "snapshots"))
    t.upsert(e)
    t.upsert(e.where("event_type = 'error'").select("event_id", F.lit("corrected").alias("event_type"), F.lit(0.0).alias("value")))
    return t.read()


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*[c.to_pylist() for c in b.columns], strict=True)
        yield pa.record_batch([pa.array([b"\0\0\0\0\1" + write_avro(list(r[:-1]))[: -1 if r[-1] else None] for r in rows], pa.binary())], ["value"])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events as framed records; those of one payment mode have lost their last byte."""
    ship(spark)
    own = {name: F.unix_millis("event_time") if kind == "millis" else F.col(name) for name, kind in AVRO_FIELDS}
    cut = F.coalesce(F.col("payment_mode") == "emi", F.lit(False))
    return raw_events(spark, sf_dir).select(*[c.alias(name) for name, c in own.items()], cut.alias("cut")).mapInArrow(_framed, "value binary")


@query
def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(messages(spark, sf_dir))[0]


@query
def decode_error_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that could not be read, from their table, whose old months have been dropped."""
    store, errors = Store(spark, scratch(spark, "errors")), decode(messages(spark, sf_dir))[1]
    store_errors(store, errors)
    store_errors(store, errors.withColumn("captured_at", F.lit(datetime.datetime(2020, 1, 1))))
    gone = purge_errors(store, datetime.date.today())
    return store.read("decode_errors").agg(F.count(F.lit(1)).alias("errors")).withColumn("dropped", F.lit(",".join(gone)))


@query
def metrics_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics written as CSV with blanks and read back with what blanks stand for."""
    e, at = table(spark, sf_dir, "events"), scratch(spark, "csv")
    given = {"ts": F.col("ts").cast("string"), "phase": F.col("event_type"), "actual_produce_rate": F.col("value"), "kafka_lag": F.when(F.col("event_type") != "view", F.col("event_id")), "errors": F.when(F.col("event_type") != "error", 1)}
    sinks.write_metrics_csv(e.select(*[given.get(f.split(" ")[0], F.lit(None).cast("string")).alias(f.split(" ")[0]) for f in METRICS.split(", ")]), at)
    rows, malformed = metrics_csv(spark, at)
    g = rows.groupBy("phase").agg(F.count(F.lit(1)).alias("rows"), F.sum("kafka_lag").alias("lag"), F.sum("errors").alias("errors"), F.max("latency_p99_ms").alias("p99"), expr.cents(F.sum("actual_produce_rate")).alias("rate"))
    return g.withColumn("malformed", F.lit(malformed.count()).cast("bigint"))


@query
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent and received events as two streams, joined."""
    at, name = scratch(spark, "latency"), "tributary_latency"
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("sent_at"))
    e.write.parquet(f"{at}/sent")
    e.where("event_id % 3 <> 0").select("event_id", (F.col("sent_at") + F.expr("make_dt_interval(0, 0, 0, (event_id % 400) - 20)")).alias("received_at")).write.parquet(f"{at}/received")
    read = lambda side, kind: spark.readStream.schema(f"event_id long, {kind} timestamp").parquet(f"{at}/{side}")
    joined = pipeline.latency(read("sent", "sent_at"), read("received", "received_at"))
    joined.writeStream.queryName(name).format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, latency_ms double").parquet(f"{at}/out")


@query
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day, category and type by a windowed aggregate over a stream, as its updates leave it."""
    at = scratch(spark, "windows")
    D.first_per_id(raw_events(spark, sf_dir)).write.parquet(f"{at}/in")
    kept: list[DataFrame] = []
    w = pipeline.windowed(event_stream(spark, f"{at}/in", 1_000), "1 day", "60 days")
    w.writeStream.outputMode("complete").option("checkpointLocation", f"{at}/cp").foreachBatch(lambda b, _: kept.append(stage(b, "windows")) and None).trigger(availableNow=True).start().awaitTermination()
    return kept[-1].select(F.col("window.start").alias("window_start"), "category", "event_type", "events", expr.cents(F.col("revenue")).alias("revenue"))


@query
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that were sent and are not stored, and whether the sets are the same without them."""
    raw = raw_events(spark, sf_dir).select("event_id")
    store = job(spark, sf_dir).read("events").select("event_id")
    lost = quality.missing(raw, store, "event_id")
    same = quality.same_set(raw.join(lost, "event_id", "left_anti"), store)
    return lost.withColumn("others_same", F.lit(same))


@query
def live_then_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest-first buffer: live payments before polled orders, 200 rows at most."""
    e = D.first_per_id(raw_events(spark, sf_dir)).select("event_id", "event_time", "event_type")
    return sinks.newest_first(e.where("event_type = 'PAYMENT_SUCCESS'").orderBy(F.desc("event_time")).limit(120), e.where("event_type = 'ORDER_CREATED'"), 200)


@query
def savepoint_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs and times of savepoint folders, of which one of each type is no such folder."""
    e = table(spark, sf_dir, "events")
    made = F.concat(F.lit("s3://sp/"), F.col("event_type"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd_HH-mm"))
    paths = e.select(made.alias("path")).distinct().unionByName(e.select(F.concat(F.lit("s3://sp/"), F.col("event_type"), F.lit("/junk")).alias("path")).distinct())
    return maintenance.savepoints(paths, "s3://sp").groupBy("job_id").agg(F.count(F.lit(1)).alias("savepoints"), F.max("created_at").alias("newest"))


@query
def bound_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with named parameters, through the row and table forms of its result."""
    views = {"tributary_bound": table(spark, sf_dir, "events")}
    rows = sinks.run_sql(spark, "select event_type, count(*) as n, sum(event_id) as ids from tributary_bound where value >= :least and event_type <> :kind group by 1", {"least": 100.0, "kind": "vi'ew"}, views)
    header, *body = sinks.table_form(spark.createDataFrame(rows, "event_type string, n long, ids long"))
    key = sinks.cache_key("events", least=100.0)
    return spark.createDataFrame([(*r, key) for r in body], T.StructType([T.StructField(header[0], T.StringType()), T.StructField(header[1], T.LongType()), T.StructField(header[2], T.LongType()), T.StructField("cache_key", T.StringType())]))


@query
def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return g.select("o_orderpriority", expr.usd(n + 0.25).alias("usd"), expr.compact(n * 1_000).alias("thousands"), expr.compact(n).alias("plain"), expr.percent(F.lit(0.125)).alias("pct"))


@query
def generator_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for generated events, as counts of what breaks it."""
    s, u = sessions(spark, 2_000, seed=5), uniform(spark, 5_000, seed=5)
    ids = s.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "PAYMENT_SUCCESS").alias("paid"), F.count_if(F.col("event_type") == "ORDER_CREATED").alias("ordered"))
    broken = ids.agg(F.count_if(F.col("n") > STEPS).alias("too_long"), F.count_if((F.col("paid") > 0) & (F.col("ordered") == 0)).alias("paid_unordered"), F.count_if(F.col("paid") > 1).alias("paid_twice"))
    again = quality.same_set(s.select("event_id", "event_type", "user_id"), sessions(spark, 2_000, seed=5).select("event_id", "event_type", "user_id"))
    twice = s.count() - s.select("event_id").distinct().count() + u.count() - u.select("event_id").distinct().count()
    return broken.withColumns({"repeated_ids": F.lit(twice).cast("bigint"), "same_again": F.lit(again)})
