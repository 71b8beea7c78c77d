"""Every registered query over the driver's tables. The SQL that each must agree with is in tributary/oracles.py."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.expr import GRANULARITY, WINDOW_HOURS, cents, period_hours, ratio, rounded
from tributary.operators import clean as C
from tributary.operators import dedup as D
from tributary.operators import erasure, logs, maintenance, perf, quality
from tributary.plans import catalog as Q
from tributary.plans import rollup as R
from tributary.registry import QUERIES, query
from tributary.sources.events import as_of, raw_events, table
from tributary.sources.generator import sessions

#: An instant amid the data, so that a freshness window has something on either side.
MIDWAY = datetime.datetime(2024, 1, 16)
#: The freshness window of the queries that show it; the reference instant is MIDWAY.
SKEW_HOURS = 48.0
#: Hours within which an event that is sent again is a repeat.
DEDUP_HOURS = 2.0

def stored(spark: SparkSession, sf_dir: str, since: datetime.datetime | None = None) -> DataFrame:
    """Valid events, each once. since: the least time that is asked for; what is older by more than an id is remembered is not even read."""
    if since is None:
        return D.first_per_id(C.clean(raw_events(spark, sf_dir)))
    once = D.first_per_id(C.clean(raw_events(spark, sf_dir, since - datetime.timedelta(hours=DEDUP_HOURS))))
    return once.where(F.col("event_time") >= F.lit(since))


def back(at: datetime.datetime, hours: float) -> datetime.datetime:
    return at - datetime.timedelta(hours=hours)


# --- validation and dedup


@query
def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(raw_events(spark, sf_dir), MIDWAY, SKEW_HOURS)


@query
def dlq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.lit(int(MIDWAY.replace(tzinfo=datetime.UTC).timestamp() * 1000)).cast("bigint")
    bad = C.tagged(raw_events(spark, sf_dir), MIDWAY, SKEW_HOURS).where(F.col("reason").isNotNull())
    return bad.select("reason", "event_id", "event_time", ms.alias("ingest_ts"))


@query
def dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.lit(0).cast("bigint")
    letters = C.dead_letters(raw_events(spark, sf_dir), ms)
    payload = F.col("raw_payload")
    pick = lambda k: F.get_json_object(payload, f"$.{k}")
    return letters.select("reason", pick("event_id").alias("event_id"), pick("event_type").alias("event_type"), pick("category").alias("category"), pick("quantity").cast("int").alias("quantity"))


@query
def dlq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.regexp_extract(F.col("reason"), r"^(missing required field: \w+|\w+)", 1)
    return C.tagged(raw_events(spark, sf_dir), MIDWAY, SKEW_HOURS).groupBy(F.coalesce(rule, F.lit("valid")).alias("rule")).agg(F.count(F.lit(1)).alias("events"))


@query
def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.first_seen(raw_events(spark, sf_dir)).select("event_id", "event_time", "event_type")


@query
def dedup_short_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With 30 seconds to live, an event sent again after a minute is new."""
    return D.first_seen(raw_events(spark, sf_dir), ttl_hours=30 / 3600).select("event_id", "event_time", "event_type")


@query
def dedup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return raw.agg(F.count(F.lit(1)).alias("received"), F.count_distinct("event_id").alias("forwarded"), (F.count(F.lit(1)) - F.count_distinct("event_id")).alias("duplicates_dropped"))


@query
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select(F.col("event_type"), (F.col("user_id") % 10).alias("shard"), F.col("ts").alias("ingest_ts"), "event_id")
    return D.latest_version(v, ("event_type", "shard"))


@query
def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    fresh = e.where("event_id % 7 = 0").select("event_id", F.lit("corrected").alias("event_type"), F.lit(0.0).alias("value"))
    return D.upsert(e, fresh)


@query
def produced_consumed_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id"), F.col("ts").cast("timestamp").alias("sent_at"))
    got = e.where("event_id % 3 <> 0").select("event_id", (F.col("sent_at") + F.expr("make_dt_interval(0, 0, 0, (event_id % 400) - 20)")).alias("received_at"))
    return D.correlate(e, got)


# --- rollups


@query
def rollup_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rollup_1min(stored(spark, sf_dir))


@query
def rollup_hll(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = R.rollup_1min(stored(spark, sf_dir), sketch=True)
    return r.groupBy("category").agg(F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("uniq_users")).alias("users"))


@query
def rollup_hll_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the estimates from merged sketches are within three standard errors (1.6 % each, and one user) of the exact counts."""
    s = stored(spark, sf_dir)
    sketched = R.rollup_1min(s, sketch=True).groupBy("category").agg(F.hll_sketch_estimate(F.hll_union_agg("uniq_users")).alias("estimate"))
    exact = s.groupBy(F.col("category").alias("_category")).agg(F.count_distinct("user_id").alias("users"))
    both = exact.join(sketched, F.col("_category").eqNullSafe(F.col("category")))
    return both.select("category", "users", (F.abs(F.col("estimate") - F.col("users")) <= 0.048 * F.col("users") + 1).alias("within_bound"))


@query
def kpi_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.kpi_1min(R.kpi_partials(stored(spark, sf_dir)))


@query
def kpi_1min_merge_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from three batches' partials."""
    s = stored(spark, sf_dir)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    parts = [R.kpi_partials(s.where(third == i)) for i in range(3)]
    return R.kpi_1min(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def funnel_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.funnel_5min(R.funnel_partials(stored(spark, sf_dir)))


@query
def kpi_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.kpi_latest(R.kpi_1min(R.kpi_partials(stored(spark, sf_dir, back(at, 2)))), at)


@query
def funnel_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.funnel_latest(R.funnel_5min(R.funnel_partials(stored(spark, sf_dir, back(at, 7)))), at)


@query
def kpi_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuilt from the latest versions of raw rows, so that repeats do not inflate it."""
    raw = C.clean(raw_events(spark, sf_dir)).withColumn("ingest_ts", F.col("event_time"))
    last = D.latest_version(raw, ("event_type", "category", "event_id"))
    return R.kpi_1min(R.kpi_partials(last)).groupBy("event_type").agg(F.sum("events").alias("events"), F.sum("total_qty").alias("total_qty"), cents(F.sum("total_revenue")).alias("total_revenue"))


@query
def funnel_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnels rebuilt from the latest versions of raw rows."""
    raw = C.clean(raw_events(spark, sf_dir)).withColumn("ingest_ts", F.col("event_time"))
    return R.funnel_5min(R.funnel_partials(D.latest_version(raw, ("event_type", "category", "event_id"))))


@query
def hourly_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.hourly_category(stored(spark, sf_dir))


# --- dashboard and ad-hoc queries

#: Queries over minutes, with the hours back from now that each of them looks at.
OVER_CUBE = {
    "revenue_by_category": 24, "event_types_last_hour": 1, "payment_success_by_mode": 168, "hourly_timeseries": 72, "unique_users_by_device": 24, "cart_abandonment": 720, "aov_by_hour_of_day": 168,
    "event_type_distribution": 24, "peak_hours": 720, "category_leaderboard": 168, "minute_rollup_top20": 1, "per_minute_by_type": 1,
}

for _name, _hours in OVER_CUBE.items():

    def _over_cube(spark: SparkSession, sf_dir: str, plan=getattr(Q, _name), hours: float = _hours) -> DataFrame:
        at = as_of(spark, sf_dir)
        return plan(R.measures(stored(spark, sf_dir, back(at, hours))), at)

    _over_cube.__name__ = _name
    query(_over_cube)

for _g in GRANULARITY:

    def _series(spark: SparkSession, sf_dir: str, g: str = _g) -> DataFrame:
        window, at = "30d" if g in ("1h", "1d") else "24h", as_of(spark, sf_dir)
        return Q.revenue_timeseries(stored(spark, sf_dir, back(at, WINDOW_HOURS[window])), at, window, g)

    _series.__name__ = f"revenue_timeseries_{_g}"
    query(_series)


@query
def realtime_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.realtime_kpis(stored(spark, sf_dir, back(at, 24)), at)


def _funnel(spark: SparkSession, sf_dir: str, period: str, group_by: str = "category", **settings) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.funnel(stored(spark, sf_dir, back(at, period_hours(period))), at, period, group_by, **settings)


@query
def funnel_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _funnel(spark, sf_dir, "30d")


@query
def funnel_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _funnel(spark, sf_dir, "7d", "event_type")


@query
def global_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.global_funnel(_funnel(spark, sf_dir, "30d"))


@query
def top5_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.top5_categories(_funnel(spark, sf_dir, "30d"))


@query
def funnel_by_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel's rows by a measure of the user's choice."""
    return _funnel(spark, sf_dir, "30d", sort="conversion_rate")


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.top_products(stored(spark, sf_dir, back(at, 168)), at)


@query
def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.live_events(stored(spark, sf_dir))


@query
def live_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 200 of one type: filter first, then the bounded newest-first buffer."""
    s = stored(spark, sf_dir).where(F.col("event_type") == "PAYMENT_SUCCESS")
    return Q.live_events(s, 200).select("event_id", "user_id", "price")


@query
def events_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = as_of(spark, sf_dir)
    return Q.events_by_type(stored(spark, sf_dir, back(at, 24)), at, 86_400)


@query
def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.user_days(stored(spark, sf_dir), "USR-00007")


@query
def timeseries_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = as_of(spark, sf_dir)
    paid = F.col("event_type") == "PAYMENT_SUCCESS"
    aggs = {"events": F.count(F.lit(1)), "payments": F.count_if(paid), "revenue": cents(F.coalesce(F.sum(F.when(paid, F.col("price"))), F.lit(0.0)))}
    post = {"revenue_per_event": rounded(ratio(F.col("revenue"), F.col("events")), 4)}
    return Q.timeseries(stored(spark, sf_dir, end - datetime.timedelta(days=3)), "event_time", end - datetime.timedelta(days=3), end, "1h", aggs, F.col("device") == "web", post, descending=True)


# --- quality, erasure, upkeep


@query
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suite(stored(spark, sf_dir), MIDWAY)


@query
def sample_every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling operator: at most 100 rows, evenly spaced by event_id."""
    return quality.every_nth(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), 100, ["event_id"])


@query
def erasure_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return erasure.preview(stored(spark, sf_dir), "USR-00007")


@query
def erased_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = erasure.without_user(stored(spark, sf_dir), "USR-00007")
    return left.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count("user_id").alias("of_users"))


@query
def keep_newest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("job_id"), F.col("ts").alias("created_at"))
    return maintenance.beyond_newest(v, "job_id", "created_at", 2, MIDWAY)


@query
def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return maintenance.expired_partitions(days, "day", datetime.date(2024, 1, 31), 14)


@query
def service_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.max("value") > 300, "up").otherwise("slow")
    return quality.health(table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name")).agg(status.alias("status")))


# --- load-test statistics and logs


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as rows of a load test, a phase for each type."""
    names = {"signup": "warmup", "error": "steady_low", "click": "steady_mid", "view": "steady_high", "purchase": "recovery"}
    phase = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("event_type"))
    v, i = F.col("value"), F.col("event_id")
    return table(spark, sf_dir, "events").select(
        phase.alias("phase"), F.col("ts").cast("timestamp").alias("ts"), F.lit(1000).alias("target_rate"), i.alias("produced_total"), (v * 100).alias("actual_produce_rate"), (v * 90).alias("actual_consume_rate"), F.when(i % 50 == 0, -1).otherwise(i % 1000).alias("kafka_lag"),
        v.alias("latency_p50_ms"), (v * 2).alias("latency_p95_ms"), (v * 3).alias("latency_p99_ms"), (v * 4).alias("latency_max_ms"), (i % 100).alias("latency_samples"), (i % 5000).alias("checkpoint_duration_ms"),
        (i % 64).cast("double").alias("checkpoint_size_mb"), (i % 90).cast("double").alias("flink_jm_cpu_pct"), (i % 2048).cast("double").alias("flink_jm_mem_mb"), (i % 70).cast("double").alias("flink_tm1_cpu_pct"), (i % 4096).cast("double").alias("flink_tm1_mem_mb"),
        (i % 50).cast("double").alias("kafka1_cpu_pct"), (i % 1024).cast("double").alias("kafka1_mem_mb"), (i % 3).alias("errors"),
        F.when(i % 100 == 0, F.concat(F.lit("RECOVERED_IN_"), (i % 80).cast("string"), F.lit("s"))).otherwise("RUNNING").alias("flink_job_status"),
    )


@query
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perf.indexed_percentiles(table(spark, sf_dir, "events"), ["event_type"], "value")


@query
def phase_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = perf.phase_stats(_metrics(spark, sf_dir))
    return s.withColumns({name: cents(F.col(name)) for name in [*perf.MEANS, "produce_rate_max", "produce_rate_p95", "latency_max"]})


@query
def slo_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = perf.phase_stats(_metrics(spark, sf_dir).where("phase <> 'warmup'"))
    return perf.evaluate(stats).select("slo", "phase", "target", "verdict")


@query
def counter_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = perf.rates(_metrics(spark, sf_dir), "produced_total", "ts", ["phase"])
    return r.select("phase", "ts", rounded(F.col("rate"), 6).alias("rate"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of three services made from the events, in all forms that they come in; one in eleven fits no pattern."""
    i, at = F.col("event_id"), F.col("ts").cast("timestamp")
    f, c = F.date_format, lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    n, turn = i.cast("string"), F.call_function("div", i, F.lit(3))
    pick = lambda forms: F.element_at(F.array(*forms), (turn % len(forms)).cast("int") + 1)
    s, h = f(at, "yyyy-MM-dd HH:mm:ss,SSS"), f(at, "yyyy.MM.dd HH:mm:ss.SSS")
    k = c("[", s, "]")
    instant = F.struct((F.unix_millis(at) / 1000).cast("bigint").alias("epochSecond"), (F.unix_millis(at) % 1000 * 1_000_000).alias("nanoOfSecond"))
    record = F.to_json(F.struct(F.lit("INFO").alias("level"), F.lit("com.acme.Coordinator").alias("loggerName"), c("Triggering checkpoint ", n).alias("message"), F.lit("Sink (2/4)").alias("thread"), instant.alias("instant")))
    stream = pick([
        c(s, " WARN [Dedup (", (i % 4 + 1).cast("string"), "/4)] com.acme.Job - Checkpoint ", n, " failed: expired"), c(s, " ERROR Backpressure at the sink"), record,
        c(s, " INFO dedup dropped ", (i % 7).cast("string"), " rows"), c(s, " ERROR IOException in operator"),
    ])
    broker = pick([
        c(k, " INFO [Partition clean-", (i % 12).cast("string"), "] Shrinking ISR for leaderId=", (i % 3).cast("string"), " (kafka.cluster.Partition)"), c(k, " WARN New leader for clean-3 leaderId=1 (kafka.server.X)"),
        c(k, " ERROR Under-replicated partitions: ", n),
    ])
    store = pick([
        c(h, " [ ", (i % 90).cast("string"), " ] {q", n, "} <Information> executeQuery: Read ", (i * 3).cast("string"), " rows from shop.kpi in ", F.format_string("%d.5", i % 10), " sec"),
        c(h, " [ 12 ] <Warning> materialized view shop.kpi_mv refreshed"), c(h, " <Error> ", F.repeat(F.lit("x"), 500)),
    ])
    line = F.when(i % 11 == 0, c("garbled ", n)).when(i % 3 == 0, stream).when(i % 3 == 1, broker).otherwise(store)
    container = F.when(i % 3 == 0, "flink-taskmanager-1").when(i % 3 == 1, "kafka-1").otherwise("clickhouse-1")
    return table(spark, sf_dir, "events").select(container.alias("container"), line.alias("message"), i.alias("event_id"))


@query
def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = logs.parse(log_lines(spark, sf_dir))
    return p.select("service", "ts", "level", "checkpoint_id", "subtask", "leader_id", "elapsed_ms", "rows", F.array_join("tags", ",").alias("tags"))


@query
def log_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = logs.parse(log_lines(spark, sf_dir))
    # explode() would have the scan drop lines without tags first, by the whole parse as one condition
    return p.select("service", F.explode_outer("tags").alias("tag")).where(F.col("tag").isNotNull()).groupBy("service", "tag").agg(F.count(F.lit(1)).alias("lines"))


@query
def dlq_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which more than one event in a hundred is rejected."""
    return logs.dead_letter_rate(C.tagged(raw_events(spark, sf_dir)), minutes=1440)


@query
def metric_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, v = F.col("event_id"), F.col("value")
    m = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("module"), (i % 20).cast("string").alias("host"), F.col("ts").cast("timestamp").alias("ts"), v.alias("cpu_user_pct"), (v / 4).alias("cpu_system_pct"),
        (v / 2).alias("memory_pct"), (i * 3).alias("lag"), (i % 7).alias("running_jobs"), (v * 1e7).alias("memory_bytes"),
    )
    a = logs.routed(logs.alerts(m))
    return a.select("index", F.explode("alerts").alias("alert")).groupBy("index", "alert").agg(F.count(F.lit(1)).alias("records"))


@query
def generated_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic source: event types of 1,000 seeded sessions."""
    return sessions(spark, 1_000, seed=1).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


# --- extensions over the star schema: what the event queries do not use


@query
def ext_revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    sold = li.select("l_orderkey", F.expr("l_extendedprice * (1 - l_discount)").alias("amount"))
    own = o.select("o_orderkey", "o_custkey").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    g = sold.join(own, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("c_nationkey").agg(F.sum("amount").alias("amount"))
    return g.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", cents(F.col("amount")).alias("revenue"))


@query
def ext_pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), cents(F.sum("l_extendedprice")).alias("sum_base_price"), F.count(F.lit(1)).alias("count_order"))


@query
def ext_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query
def ext_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query
def ext_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    c = table(spark, sf_dir, "customer").where("c_nationkey < 15").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    j = s.join(c, F.col("s_nationkey") == F.col("c_nationkey"), "full")
    return j.select(F.coalesce("s_nationkey", "c_nationkey").alias("nationkey"), "suppliers", "customers")


@query
def ext_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the value of its user's last view before it: a union sorted per user, not a range join."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "purchase"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("event_type") == "view", F.col("value")), ignorenulls=True).over(w)
    return e.withColumn("last_view_value", last).where("event_type = 'purchase'").select("event_id", "user_id", "last_view_value")


@query
def ext_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within 6 hours of a user's error: an equi-join on the user and 6-hour bins, then the exact bounds."""
    e = table(spark, sf_dir, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    width = 6 * 3_600_000_000
    bad = e.where("event_type = 'error'").select("user_id", F.col("at").alias("from"), F.call_function("div", F.col("at"), F.lit(width)).alias("bin"))
    bad = bad.unionByName(bad.withColumn("bin", F.col("bin") + 1))
    buy = e.where("event_type = 'purchase'").select("user_id", "at", F.call_function("div", F.col("at"), F.lit(width)).alias("bin"))
    near = buy.join(bad, ["user_id", "bin"]).where((F.col("at") >= F.col("from")) & (F.col("at") < F.col("from") + width))
    return near.groupBy("user_id").agg(F.count(F.lit(1)).alias("pairs"))


@query
def ext_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query
def ext_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query
def ext_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.stddev_samp("l_quantity").alias("sd"), F.median("l_quantity").alias("median_qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    return g.withColumn("sd", rounded(F.col("sd"), 6))


@query
def ext_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten dearest orders of each priority. They are found by a limited window first, so that the others need no window of their own."""
    w = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("rank", F.rank().over(w)).where("rank <= 10")
    return o.select("o_orderpriority", "o_orderkey", F.col("rank").cast("bigint").alias("rank"), F.lag("o_totalprice").over(w).alias("previous"))


@query
def ext_window_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense rank, quartile, share of rows at or below, next, first and moving values over the nations' customers."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    by, order = Window.partitionBy(F.col("c_nationkey") % 5), [F.desc("customers"), "c_nationkey"]
    w = by.orderBy(*order)
    return c.select(
        "c_nationkey", "customers", F.dense_rank().over(by.orderBy(F.desc("customers"))).cast("bigint").alias("dense"), F.ntile(4).over(w).cast("bigint").alias("quartile"), rounded(F.cume_dist().over(w), 6).alias("cume"), rounded(F.percent_rank().over(w), 6).alias("pct"),
        F.lead("customers").over(w).alias("next"), F.first_value("customers").over(w).alias("most"), F.sum("customers").over(w.rowsBetween(-1, 1)).alias("around"),
    )


@query
def ext_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by two sets of columns at once, and aggregates that the event queries do not use."""
    li = table(spark, sf_dir, "lineitem")
    sets = li.groupingSets([["l_returnflag", "l_linestatus"], ["l_linestatus"], []], "l_returnflag", "l_linestatus")
    return sets.agg(
        F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"), rounded(F.var_pop("l_quantity"), 4).alias("variance"), F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey", "l_linenumber")).alias("dearest"),
        F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"),
    )


@query
def ext_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 50 events of a user each, in order: their span and their value."""
    e = table(spark, sf_dir, "events")
    place = F.call_function("div", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1, F.lit(50)).cast("bigint")
    g = e.withColumn("part", place).groupBy("user_id", "part").agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return g.select("user_id", "part", "events", "first_ts", "last_ts")


@query
def ext_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    both = c.intersect(s).select("k", F.lit("both").alias("side"))
    return both.unionByName(c.subtract(s).select("k", F.lit("customers").alias("side"))).unionByName(s.subtract(c).select("k", F.lit("suppliers").alias("side")))


@query
def ext_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.window("ts", "2 days", "1 day")["start"].alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("events"))


@query
def ext_session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sessions, which end after 12 hours without an event."""
    e = table(spark, sf_dir, "events")
    g = e.groupBy("user_id", F.session_window("ts", "12 hours").alias("s")).agg(F.count(F.lit(1)).alias("events"))
    return g.select("user_id", F.col("s.start").alias("session_start"), "events")


from tributary import job_queries  # noqa: E402, F401  they register themselves, after these
