"""Quality, upkeep, erasure, logs, load-test statistics, generator, schema rules."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import expr
from tributary.functions.files import Files
from tributary.operators import erasure, logs, maintenance, perf, quality
from tributary.plans import catalog
from tributary.schema import DEVICES, EVENT, EVENT_TYPES, check_evolution
from tributary.sources import generator

NOW = datetime.datetime(2024, 1, 16, 12)


def test_quality_suite(spark):
    good = [("abcdef0%d" % i, "session-%d" % i, NOW, "VIEW", "web", "1.1.1.1", None, None, "books", 1, 1.0, None) for i in range(10)]
    result = quality.suite(spark.createDataFrame(good, EVENT), NOW)
    v = quality.publish(result, "events", "now")
    assert v["suite_passed"] and v["expectations"] == 16 and v["row_count"] == 10
    bad = spark.createDataFrame([*good, ("zz", None, NOW - datetime.timedelta(days=3), "NOPE", "tv", "1", None, None, "B!", -1, -1.0, None)], EVENT)
    v = quality.publish(quality.suite(bad, NOW), "events", "now", most_failures=3)
    assert not v["suite_passed"] and v["failed"] > 5 and len(v["failed_details"]) == 3
    v = quality.publish(quality.suite(bad.limit(0), NOW), "events", "now")
    assert [d["expectation"] for d in v["failed_details"]] == ["row_count"]


def test_quality_run(spark):
    """The sample is of the last hour; a failed suite is stored and told, and fails its run if it is to."""
    e = spark.createDataFrame([("abcdef%03d" % i, "session-%d" % i, NOW - datetime.timedelta(minutes=i), "VIEW", "tv" if i < 5 else "web", "1.1.1.1", None, None, "books", 1, 1.0, None) for i in range(200)], EVENT)
    sample = quality.recent_sample(e, NOW, most=20).collect()
    assert len(sample) == 20 and min(r["event_time"] for r in sample) >= NOW - datetime.timedelta(hours=1)
    result, told, stored = quality.suite(quality.recent_sample(e, NOW), NOW), [], []
    v = quality.publish(result, "events", "now", write=lambda v: stored.append(v) or "there", alert=told.append)
    assert v["stored"] == "there" and v["failed"] == 1 and "device_in_set on device" in told[0] and stored[0]["suite_passed"] is False
    assert quality.publish(result, "events", "now", write=lambda v: 1 / 0)["stored"] is None
    with pytest.raises(quality.QualityError, match="1 of 16"):
        quality.publish(result, "events", "now", alert=told.append, fail=True)
    assert len(told) == 2
    quality.publish(quality.suite(e.where("device = 'web'").limit(60), NOW), "events", "now", alert=told.append, fail=True)
    assert len(told) == 2


def test_every_nth(spark):
    ids = lambda n, most: sorted(r["id"] for r in quality.every_nth(spark.range(n), most, ["id"]).collect())
    assert ids(100, 10) == list(range(0, 100, 10)) and ids(5, 10) == list(range(5)) and ids(105, 10) == list(range(0, 100, 10)) and ids(0, 10) == []


def test_health(spark):
    one = lambda *s: quality.health(spark.createDataFrame([(str(i), x) for i, x in enumerate(s)], "name string, status string")).first()["status"]
    assert one("up", "up") == "healthy" and one("up", "down") == "unhealthy" and one("up", "slow") == "degraded"


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(20).write.parquet(path)
    assert maintenance.compact(spark, path, dry_run=True)["written"] == 0 and maintenance.table_stats(spark, path)["files"] == 20
    done = maintenance.compact(spark, path)
    assert done["small_files"] == 20 and done["written"] == 1
    assert maintenance.table_stats(spark, path) == {"rows": 1000, "files": 1, "bytes": Files(spark, path).data()[0][1], "warnings": []}
    assert maintenance.compact(spark, path)["written"] == 0
    (tmp_path / "store" / "_log").mkdir(parents=True)
    with pytest.raises(ValueError, match="store"):
        maintenance.compact(spark, str(tmp_path / "store"))


@pytest.mark.parametrize("kill", [None, "move", "delete", "write_new"])
@pytest.mark.parametrize("after", [0, 1, 3])
def test_compaction_of_partitions(spark, tmp_path, monkeypatch, kill, after):
    """Each folder is packed by itself: partition columns stay; a kill anywhere is made good by the next run."""
    path = str(tmp_path / "t")
    df = spark.sql("select id, date_add(date'2024-01-01', cast(id % 3 as int)) as day, cast(id % 2 as int) as batch_id from range(600)")
    df.repartition(4).write.partitionBy("batch_id", "day").parquet(path)
    want = sorted(map(tuple, df.collect()))
    read = lambda: sorted((r["id"], r["day"], r["batch_id"]) for r in spark.read.parquet(path).collect())
    assert read() == want and maintenance.table_stats(spark, path)["files"] == 24
    if kill:
        real, calls = getattr(Files, kill), []

        def killed(self, *a):
            calls.append(1)
            if len(calls) > after:
                raise KeyboardInterrupt
            return real(self, *a)

        with monkeypatch.context() as m:
            m.setattr(Files, kill, killed)
            with pytest.raises(KeyboardInterrupt):
                maintenance.compact(spark, path)
        assert set(read()) == set(want)
        maintenance.recover(spark, path)
        assert read() == want
    maintenance.compact(spark, path)
    assert read() == want and maintenance.table_stats(spark, path)["files"] == 6
    assert not [p for p in (tmp_path / "t").rglob("*compact-*") if p.name.startswith(".compact") and p.suffix != ".crc"]


def test_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) as day from range(10)").write.partitionBy("day").parquet(f"{path}/batch_id=0")
    old = [f"batch_id=0/day=2024-01-0{k}" for k in (1, 2, 3)]
    assert maintenance.purge(spark, path, "day", datetime.date(2024, 1, 10), 6, dry_run=True) == old
    assert maintenance.purge(spark, path, "day", datetime.date(2024, 1, 10), 6) == old and spark.read.parquet(path).count() == 7


def test_snapshots(spark, tmp_path):
    t = maintenance.SnapshotTable(spark, str(tmp_path / "t"))
    row = lambda *p: spark.createDataFrame(list(p), "event_id string, v int")
    t.upsert(row(("a", 1), ("b", 1)))
    t.upsert(row(("b", 2), ("c", 2)))
    assert sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert t.read(t.snapshots()[0]).count() == 2
    week = time.time() + 7.5 * 86_400
    assert t.expire()["expired"] == 0 and t.expire(now=week, dry_run=True)["expired"] == 1 and len(t.snapshots()) == 2
    assert t.expire(now=week)["expired"] == 1 and len(t.snapshots()) == 1 and t.read().count() == 3
    assert t.stats(now=week)["snapshot_age_hours"] == 180.0


def test_savepoint_rotation(spark, tmp_path):
    (tmp_path / "cp" / "offsets").mkdir(parents=True)
    (tmp_path / "cp" / "offsets" / "0").write_text("v1")
    sp = maintenance.Savepoints(spark, str(tmp_path / "sp"))
    made = [sp.trigger(job, str(tmp_path / "cp"), NOW - datetime.timedelta(days=d)) for job, days in (("a", (20, 15, 10, 1)), ("b", (30, 25))) for d in days]
    assert [sp.wait(m) for m in made] == ["COMPLETED"] * 6 and sp.poll("a/none") == "UNKNOWN"
    assert (tmp_path / "sp" / made[0] / "offsets" / "0").read_text() == "v1"
    with pytest.raises(ValueError):
        sp.trigger("a", str(tmp_path / "cp"), NOW - datetime.timedelta(days=1))
    assert sp.wait(sp.trigger("c", str(tmp_path / "none"), NOW)) == "FAILED"
    assert len(sp.inventory()) == 6
    old = sp.rotate(NOW, dry_run=True)
    assert old == sp.rotate(NOW) == sorted(made[:2]) and {p for p, _, _ in sp.inventory()} == set(made[2:])


def test_savepoints(spark):
    p = spark.createDataFrame([("s3://b/sp/j1/2024-01-02_03-04",), ("s3://b/sp/j1/2024-01-03_03-04/",), ("s3://b/sp/junk",)], "path string")
    inv = maintenance.savepoints(p, "s3://b/sp")
    assert sorted((r["job_id"], r["created_at"].day) for r in inv.collect()) == [("j1", 2), ("j1", 3)]
    assert [r["created_at"].day for r in maintenance.beyond_newest(inv, "job_id", "created_at", 1, NOW).collect()] == [2]
    ties = spark.createDataFrame([(g, NOW - datetime.timedelta(days=d), k) for g, d, k in (("x", 1, 3), ("x", 1, 1), ("x", 1, 2), ("x", 2, 0), ("y", 1, 0), (None, 3, 0), (None, 2, 0), (None, 1, 0))], "g string, at timestamp, k int")
    gone = maintenance.beyond_newest(ties, "g", "at", 2, NOW).collect()
    assert sorted((r["g"] or "", r["k"]) for r in gone) == [("", 0), ("x", 0), ("x", 3)]


def test_erasure(spark):
    rows = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3), (None, 4)], "user_id string, v int")
    store = {"events": rows}
    io = {"events": (lambda: store["events"], lambda df: store.update(events=df))}
    audit = erasure.erase(" u1 ", io)
    assert audit["status"] == "ok" and audit["systems_erased"]["events"]["rows_deleted"] == 2
    assert sorted(r["v"] for r in store["events"].collect()) == [3, 4]
    assert erasure.erase("u1", io)["systems_erased"]["events"]["rows_deleted"] == 0

    def broken():
        raise OSError("gone")

    audit = erasure.erase("u2", {"bad": (broken, print), **io})
    assert audit["status"] == "failed" and audit["systems_erased"]["events"]["status"] == "ok"
    for bad in ("", "a'b", "x" * 129, None):
        with pytest.raises(ValueError):
            erasure.erase(bad, io)


def test_logs(spark):
    job = "a" * 32
    lines = [
        ("flink-jobmanager", f"2024-01-01 10:00:00,123 INFO  [Map (2/4)#0] org.x.Task [] - job {job} triggering checkpoint 17 watermark -5"),
        ("flink-taskmanager", '{"level":"SEVERE","loggerName":"x.Y","message":"Backpressure","thread":"Sink (1/2)","instant":{"epochSecond":1704103200,"nanoOfSecond":5000000}}'),
        ("kafka-1", "[2024-01-01 10:00:00,123] WARN [Broker id=1] New leader for clean-3 leaderId=2 (kafka.server.X)"),
        ("clickhouse-1", "2024.01.01 10:00:00.123456 [ 77 ] {q1} <Warning> executeQuery: 10 rows in shop.events in 6.5 sec"),
        ("kafka-1", "???"),
    ]
    got = logs.parse(spark.createDataFrame(lines, "container string, message string")).collect()
    assert (got[0]["job_id"], got[0]["checkpoint_id"], got[0]["watermark"], got[0]["task"], got[0]["subtask"], got[0]["parallelism"]) == (job, 17, -5, "Map", 2, 4)
    assert got[0]["tags"] == ["checkpoint_triggered"] and got[0]["ts"] == datetime.datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert got[1]["level"] == "error" and set(got[1]["tags"]) == {"backpressure", "application_error"} and got[1]["ts"].microsecond == 5000
    assert (got[2]["leader_id"], got[2]["topic_partition"], got[2]["level"]) == (2, "clean-3", "warn") and "leader_election" in got[2]["tags"]
    assert (got[3]["elapsed_ms"], got[3]["rows"], got[3]["database_table"], got[3]["tags"]) == (6500, 10, "shop.events", ["slow_query"])
    assert got[4]["tags"] == ["parse_failure"] and got[4]["text"] == "???"


def test_sustained_alerts(spark):
    p = spark.createDataFrame([("h", NOW + datetime.timedelta(minutes=m), v) for m, v in ((0, 60_000), (1, 70_000), (5, 60_000), (6, 10))], "host string, ts timestamp, lag int")
    assert logs.sustained(p, "lag", 50_000).count() == 1
    assert [r["hits"] for r in logs.frequent(p, F.col("lag") > 50_000, times=2).collect()] == [2]


def test_dead_letter_rate(spark):
    rows = [(NOW + datetime.timedelta(minutes=m), "bad" if m == 7 else None) for m in range(10) for _ in range(30)] + [(NOW, "bad")]
    out = logs.dead_letter_rate(spark.createDataFrame(rows, "event_time timestamp, reason string")).collect()
    assert [(r["window_start"], r["rejected"]) for r in out] == [(NOW + datetime.timedelta(minutes=5), 30)]


def test_log_details(spark):
    lines = [("kafka-1", "[2024-01-01 10:00:00,123] INFO [Log] Shrinking ISR from 1,2,3 for topic raw.events partition 4 highWatermark=99 leader.id: 2 (kafka.X)"), ("flink-jobmanager", "2024-01-01 10:00:00,123 WARN Task 'Dedup sink' failed")]
    got = logs.parse(spark.createDataFrame(lines, "container string, message string")).collect()
    assert (got[0]["topic"], got[0]["partition"], got[0]["offset"], got[0]["leader_id"], got[0]["isr"]) == ("raw.events", 4, 99, 2, "1,2,3") and got[1]["task_name"] == "Dedup sink"


def test_log_tags_are_counted_after_one_parse(spark):
    """Neither the scan nor a filter above it repeats the parse, and each pattern is tried once for a line."""
    from tributary.queries import log_tag_counts

    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    plan = log_tag_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxPlanStringLength")
    below = plan.split("Generate explode", 1)[1]
    assert "Filter" not in below.replace("PushedFilters", "").replace("DataFilters", "").replace("PartitionFilters", "") and len(plan) < 100_000
    assert plan.count("RLIKE(message") == sum(map(len, logs.PATTERNS.values())) + 1


def test_percentiles(spark):
    p = perf.indexed_percentiles(spark.range(1, 101).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v")), ["g"], "v").first()
    assert (p["samples"], p["p50"], p["p95"], p["p99"]) == (100, 51.0, 96.0, 100.0)
    rng, rows = random.Random(1), []
    for g, n in (("a", 1), ("b", 7), (None, 500), ("c", 1_000)):
        rows += [(g, float(rng.randint(0, 50))) for _ in range(n)]
    out = {r["g"]: r for r in perf.indexed_percentiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v").collect()}
    for g in ("a", "b", None, "c"):
        own = sorted(v for k, v in rows if k == g)
        r = out.get(g)
        if g is not None:  # groups are told apart by equality, so a null group has no percentile
            assert [r["p50"], r["p95"], r["p99"]] == [own[min(int(len(own) * p / 100), len(own) - 1)] for p in (50, 95, 99)] and r["samples"] == len(own)


def test_rates(spark):
    """The row before is found across partitions, too."""
    rng, rows = random.Random(2), []
    for g in ("a", "b", None):
        t = c = 0
        for _ in range(rng.randint(1, 300)):
            t, c = t + rng.randint(0, 5), c + rng.randint(0, 9)
            rows.append((g, NOW + datetime.timedelta(seconds=t), c))
    want = []
    for g in ("a", "b", None):
        own = sorted((t, c) for k, t, c in rows if k == g)
        want += [(g or "", t, c, None if k == 0 or t == own[k - 1][0] else (c - own[k - 1][1]) / (t - own[k - 1][0]).total_seconds()) for k, (t, c) in enumerate(own)]
    got = [(r["g"] or "", r["t"], r["c"], r["rate"]) for r in perf.rates(spark.createDataFrame(rows, "g string, t timestamp, c long").repartition(6), "c", "t", ["g"]).collect()]
    order = lambda x: (*x[:3], x[3] is None, x[3] or 0)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_service_levels(spark):
    s = spark.createDataFrame([("steady_low", 500.0, 9500.0, 10, 20.0, None), ("recovery", None, None, None, None, 100.0)], "phase string, latency_p99_mean double, produce_rate_mean double, lag_max int, checkpoint_max_ms double, recovery_s double").withColumn("latency_p95_mean", F.lit(None).cast("double"))
    v = {r["slo"]: r["verdict"] for r in perf.evaluate(s).collect()}
    assert v["steady_low_p99"] == "PASS" and v["steady_low_rate"] == "PASS" and v["recovery_s"] == "FAIL" and v["warmup_p99"] == "NO DATA" and v["steady_mid_p95"] == "NO DATA"


def test_generator(spark):
    a, b = generator.sessions(spark, 300, seed=3), generator.sessions(spark, 300, seed=3)
    assert a.exceptAll(b).count() == 0 and a.exceptAll(generator.sessions(spark, 300, seed=4)).count() > 0
    kinds = {r["event_type"] for r in a.select("event_type").distinct().collect()}
    assert kinds <= set(EVENT_TYPES) and "REFUND" not in kinds and {"VIEW", "ADD_TO_CART", "ORDER_CREATED", "PAYMENT_SUCCESS"} <= kinds
    assert {r["device"] for r in a.select("device").distinct().collect()} <= set(DEVICES)
    assert a.select("event_id").distinct().count() == a.count()
    u = generator.uniform(spark, 2000)
    assert u.where("event_type = 'REMOVE_CART'").count() == 0 and 40 < u.where("user_id is null").count() < 180


def test_evolution():
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    new = lambda *f: check_evolution(old, T.StructType(list(f)))
    a, b = old.fields
    assert new(a, b, T.StructField("c", T.StringType())) == [] and new(T.StructField("a", T.LongType()), b) == []
    assert new(a) and new(a, b, T.StructField("c", T.StringType(), False)) and new(T.StructField("a", T.StringType()), b) and new(a, T.StructField("B", T.StringType()))


def test_parameters(spark):
    assert expr.period_hours("24h") == 24 and expr.period_hours("7d") == 168
    for bad in ("24", "h", "1w", "1d; drop"):
        with pytest.raises(ValueError):
            expr.period_hours(bad)
    e = spark.createDataFrame([("e", "VIEW", NOW, "books")], "event_id string, event_type string, event_time timestamp, category string")
    assert catalog.funnel(e, NOW, "24h", "1; drop table").columns[0] == "category"
    for n in (0, 51):
        with pytest.raises(ValueError):
            catalog.top_products(e, NOW, limit=n)
    kinds = [("a", "VIEW")] * 9 + [("a", "ORDER_CREATED")] + [("b", "VIEW")] * 3 + [("b", "ORDER_CREATED")] * 2
    f = spark.createDataFrame([(t, NOW, c) for c, t in kinds], "event_type string, event_time timestamp, category string")
    order = lambda sort: [r["category"] for r in catalog.funnel(f, NOW, sort=sort).collect()]
    assert order("views") == order("no such") == ["a", "b"] and order("orders") == ["b", "a"]
    r = spark.range(1).select(expr.usd(F.lit(1234.5)).alias("a"), expr.compact(F.lit(2_500_000)).alias("b"), expr.compact(F.lit(1234)).alias("c"), expr.percent(F.lit(0.123)).alias("d")).first()
    assert tuple(r) == ("$1,234.50", "2.5M", "1.2k", "12.3%")
