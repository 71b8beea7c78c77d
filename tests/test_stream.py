"""Streams give what batches give; replays change nothing; state expires."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from tributary.operators import clean as C
from tributary.operators.dedup import first_per_id
from tributary.plans import rollup as R
from tributary.sources.events import AVRO_FIELDS, AVRO_SYMBOLS, decode, event_stream, kafka_stream, purge_errors, raw_events, read_avro, store_errors, write_avro
from tributary.streaming import dedup, pipeline
from tributary.streaming.store import Conflict, Store

SF = "/root/testdata/sf0.001"
NOW = datetime.datetime(2024, 1, 16)


def rows(df):
    return sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


def ran(query):
    assert query.awaitTermination(180)
    return query


def test_stream_is_batch(spark, tmp_path):
    """Without removal of repeats, what is stored is what a batch gives; replays change nothing; a rebuild takes repeats out of the partials."""
    raw = raw_events(spark, SF)
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "out"))
    q = ran(pipeline.start(event_stream(spark, str(tmp_path / "in"), 1), store, str(tmp_path / "cp"), now=NOW, available_now=True, dedup_hours=None))
    said = pipeline.job_summary(q, store)
    assert said["batch"] == 2 and said["version"] == 3 and said["records"] == raw.count() and said["last_checkpoint"]["batch"] == 2 and said["uptime_hours"] >= 0
    good = C.clean(raw, NOW, 48)
    assert rows(store.read("events").select(*good.columns)) == rows(good)
    assert store.read("dead_letters").count() == raw.count() - good.count()
    assert rows(pipeline.kpi_view(store)) == rows(R.kpi_1min(R.kpi_partials(good)))
    assert rows(pipeline.funnel_view(store)) == rows(R.funnel_5min(R.funnel_partials(good)))
    assert rows(pipeline.rollup_view(store).drop("uniq_users")) == rows(R.rollup_1min(good))
    before, version = rows(pipeline.kpi_view(store)), store.state()["version"]
    # a batch that has been committed changes nothing when it is run again
    assert pipeline.ingest(pipeline.judged(raw.limit(100), NOW), 1, store, str(q.id)) == version == store.state()["version"]
    assert rows(pipeline.kpi_view(store)) == before
    # repeats across batches inflate partials until they are rebuilt; a batch that comes amid it is kept
    rebuilt = pipeline.rebuild
    late = raw.where("event_id = '7'").withColumn("event_id", F.lit("new")).withColumn("event_time", F.lit(NOW).cast("timestamp"))
    replace = Store.replace

    def amid(self, *a, **k):
        pipeline.ingest(pipeline.judged(late, NOW), 0, store, "other")
        return replace(self, *a, **k)

    Store.replace = amid
    try:
        rebuilt(store)
    finally:
        Store.replace = replace
    once = first_per_id(good.unionByName(C.clean(late, NOW, 48)))
    assert rows(pipeline.kpi_view(store)) == rows(R.kpi_1min(R.kpi_partials(once)))
    assert rows(pipeline.funnel_view(store)) == rows(R.funnel_5min(R.funnel_partials(once)))


def test_validate_dedup_store(spark, tmp_path):
    """The whole job: repeats go within and across batches and after a restart, whatever their time; rejects are no one's repeats."""
    raw = raw_events(spark, SF)
    first, second = raw.where("cast(event_id as bigint) % 2 = 0"), raw.where("cast(event_id as bigint) % 2 = 1")
    odd = raw.where("event_id in ('2', '4')").withColumn("event_time", F.lit(None).cast("timestamp"))
    src, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "out"))

    def run():
        return ran(pipeline.start(event_stream(spark, src, 1), store, str(tmp_path / "cp"), max_skew_hours=None, available_now=True))

    first.unionByName(odd).coalesce(1).write.mode("append").parquet(src)
    q = run()
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "true"
    assert any("RocksDB" in str(k) or "rocksdb" in str(k) for p in q.recentProgress for s in p["stateOperators"] for k in s["customMetrics"])
    old = raw.where("event_id in ('2', '4', '6')").withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 40 DAYS"))
    second.unionByName(first).unionByName(old).unionByName(odd).coalesce(1).write.mode("append").parquet(src)
    run()
    good = C.clean(raw)
    stored = store.read("events")
    assert stored.count() == good.select("event_id").distinct().count() == stored.select("event_id").distinct().count()
    assert stored.select("event_id", "event_time").exceptAll(good.select("event_id", "event_time")).count() == 0
    assert store.read("dead_letters").count() == C.tagged(first.unionByName(odd).unionByName(second).unionByName(first).unionByName(old).unionByName(odd)).where("reason is not null").count()
    assert rows(pipeline.kpi_view(store)) == rows(R.kpi_1min(R.kpi_partials(stored)))
    late = raw.where("event_id = '3'").withColumn("event_id", F.lit("late")).withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 90 DAYS"))
    late.coalesce(1).write.mode("append").parquet(src)
    run()
    assert store.read("events").where("event_id = 'late'").count() == C.clean(late).count()


def test_batches_are_written_balanced(spark, tmp_path):
    """A batch makes one file of each small partition, however many tasks its stream has; the session's setting is left as it was."""
    raw_events(spark, SF).coalesce(1).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "out"))
    ran(pipeline.start(event_stream(spark, str(tmp_path / "in"), 1), store, str(tmp_path / "cp"), max_skew_hours=None, available_now=True))
    tables = store.state()["tables"]
    assert {e["files"] for entries in tables.values() for e in entries} == {1}
    assert len(tables["events"]) == 30 and store.stats("events")["warnings"] == []
    off = spark.newSession()
    off.conf.set("spark.sql.adaptive.enabled", "false")
    Store(off, str(tmp_path / "other")).append(off.range(10).repartition(3), "t")
    assert off.conf.get("spark.sql.adaptive.enabled") == "false" and Store(off, str(tmp_path / "other")).stats("t")["files"] == 1


def test_null_times(spark, tmp_path):
    """Events without a time are deduplicated by the clock."""
    schema = "event_id string, event_time timestamp, reason string"
    spark.createDataFrame([("a", None, None), ("a", None, None), ("b", NOW, None), ("b", None, None), ("c", None, "bad"), ("c", None, "bad")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    dedup.durable(spark)
    for extend in (False, True):
        found = []
        q = dedup.once(read(), 2, extend).writeStream.option("checkpointLocation", str(tmp_path / f"cp{extend}")).foreachBatch(lambda b, _, f=found: f.extend(r["event_id"] for r in b.collect())).start()
        try:
            for _ in range(120):
                if found or q.awaitTermination(1):
                    break
        finally:
            q.stop()
        assert sorted(found) == ["a", "b", "c", "c"], extend


def test_store_versions(spark, tmp_path):
    """A commit is seen as a whole or not at all; two that race both count; versions can be read until they expire."""
    a, b = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    row = lambda *v: spark.createDataFrame([(x,) for x in v], "v int").coalesce(1)
    with pytest.raises(KeyError):
        a.read("t")
    a.append(row(1, 2), "t")
    state = Store.state
    raced = []

    def between(self, version=None):
        out = state(self, version)
        if self is a and not raced:
            raced.append(b.append(row(3), "t"))
        return out

    Store.state = between
    try:
        assert a.append(row(4), "t") == 3
    finally:
        Store.state = state
    assert sorted(r["v"] for r in a.read("t").collect()) == [1, 2, 3, 4] and a.read("t", 1).count() == 2
    entries, schema = a.write(row(9), "t")  # written, never committed
    assert a.read("t").count() == 4
    old = [e["path"] for e in a.state(1)["tables"]["t"]]
    a.replace(row(5), "t", old)
    with pytest.raises(Conflict):
        a.replace(row(6), "t", old)
    assert sorted(r["v"] for r in a.read("t").collect()) == [3, 4, 5]
    now = time.time()
    assert a.expire(now)["expired"] == 0
    assert a.expire(now + 8 * 86_400, dry_run=True) == {"expired": 3, "retained": 1, "folders": 3} and a.versions() == [1, 2, 3, 4]
    a.expire(now + 8 * 86_400)
    assert a.versions() == [4] and sorted(r["v"] for r in a.read("t").collect()) == [3, 4, 5] and len(a.files.names("t")) == 3
    said = a.stats("t", now + 3_600)
    assert (said["rows"], said["files"], said["snapshot"], said["snapshot_age_hours"], said["warnings"]) == (3, 3, 4, 1.0, []) and a.stats("none")["warnings"] == ["table is empty"]


def test_upkeep_of_the_stream_store(spark, tmp_path):
    """Compaction, retention and expiry of what the job has written: rows, columns and partitions stay, and a kill between any two steps loses nothing."""
    raw_events(spark, SF).repartition(4).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "out"))
    ran(pipeline.start(event_stream(spark, str(tmp_path / "in"), 1), store, str(tmp_path / "cp"), max_skew_hours=None, available_now=True))
    tables = ("events", "dead_letters", *pipeline.PARTIALS)
    before, columns, views = {t: rows(store.read(t)) for t in tables}, {t: store.read(t).columns for t in tables}, rows(pipeline.kpi_view(store))
    files = store.stats("events")["files"]
    assert store.compact("events", dry_run=True)["small_files"] > 30 and store.stats("events")["files"] == files
    # a kill after each step: the data are written and not committed; or they are, and the old files are still there
    commit, write, steps = Store.commit, Store.write, []

    def killed(self, *a, **k):
        steps.append(1)
        raise KeyboardInterrupt

    for step in ("write", "commit"):
        setattr(Store, step, killed)
        try:
            with pytest.raises(KeyboardInterrupt):
                store.compact("events")
        finally:
            Store.commit, Store.write = commit, write
        assert rows(store.read("events")) == before["events"]
    for t in tables:
        store.compact(t)
        assert rows(store.read(t)) == before[t] and store.read(t).columns == columns[t]
    days = {e["partition"] for e in store.state()["tables"]["events"]}
    assert store.stats("events")["files"] == len(days) < files and store.compact("events")["written"] == 0
    assert rows(pipeline.kpi_view(store)) == views
    # pruned by date: other folders are not listed
    day = sorted(days)[-3]
    assert rows(store.read("events", since=day)) == rows(store.read("events").where(F.col("event_date") >= day))
    assert len(store.read("events", since=day).inputFiles()) == 3
    # retention by table: whole partitions go, others are not touched
    as_of = datetime.date.fromisoformat(sorted(days)[5]) + datetime.timedelta(days=30)
    assert store.purge("kpi_1min", as_of, dry_run=True) == sorted(days)[:5] and store.purge("events", as_of) == []
    store.purge("kpi_1min", as_of)
    assert {str(r["event_date"]) for r in store.read("kpi_1min").select("event_date").distinct().collect()} == set(sorted(days)[5:])
    kept = rows(store.read("events"))
    done = store.expire(time.time() + 8 * 86_400)
    assert done["expired"] > 0 and done["folders"] > 0 and rows(store.read("events")) == kept == before["events"]
    files = len(list((tmp_path / "out" / "kpi_1min").rglob("*.parquet")))
    assert files == store.stats("kpi_1min")["files"]
    # the job goes on where it was
    raw_events(spark, SF).limit(50).withColumn("event_id", F.concat(F.lit("again-"), "event_id")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ran(pipeline.start(event_stream(spark, str(tmp_path / "in"), 1), store, str(tmp_path / "cp"), max_skew_hours=None, available_now=True))
    assert store.read("events").count() > len(kept)


def test_fan_out():
    """At most so many clients; slow and failing ones are dropped, others get all."""
    out, fan = [], pipeline.FanOut(most=3, patience=0.3)
    assert fan.connect("good", out.append) and fan.connect("slow", lambda v: time.sleep(2)) and fan.connect("bad", lambda v: 1 / 0) and not fan.connect("late", out.append)
    fan.send(["a"])
    assert out == [["a"]] and set(fan.clients) == {"good"} and (fan.sent, fan.dropped) == (1, 2)


def test_live(spark, tmp_path):
    raw_events(spark, SF).limit(300).write.parquet(str(tmp_path / "in"))
    got, fan = [], pipeline.FanOut()
    fan.connect("me", got.extend)
    q = pipeline.live(event_stream(spark, str(tmp_path / "in")), fan, limit=20)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert len(got) == 20 and all("event_id" in v for v in got)


def test_any_split_merges_to_the_same(spark):
    e = C.clean(raw_events(spark, SF))
    whole = rows(R.kpi_1min(R.kpi_partials(e)))
    for n in (2, 5):
        parts = [R.kpi_partials(e.where(F.pmod(F.hash("event_id"), F.lit(n)) == i)) for i in range(n)]
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p)
        assert rows(R.kpi_1min(merged)) == whole


def test_time_to_live(spark, tmp_path):
    """First kept, repeat inside the time dropped, repeat after it kept: three files on one checkpoint."""
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    schema = "event_id string, event_time timestamp"
    add = lambda *ids: spark.createDataFrame([(i, NOW) for i in ids], schema).coalesce(1).write.mode("append").parquet(src)
    add("a", "b", "a")

    def run():
        q = dedup.first_seen(spark.readStream.schema(schema).parquet(src), ttl_hours=30 / 3600).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).start()
        try:  # batches without rows go on for ever here, so processAllAvailable() may not return
            for _ in range(60):
                if q.awaitTermination(1) or any(p["numInputRows"] for p in q.recentProgress):
                    break
        finally:
            q.stop()
        return sorted(r["event_id"] for r in spark.read.parquet(out).collect())

    began = time.time()
    assert run() == ["a", "b"]
    add("a", "c")
    got = run()
    if time.time() - began < 25:  # a slow machine may have let it expire
        assert got == ["a", "b", "c"]
    time.sleep(max(0.0, 36 - (time.time() - began)))
    add("a")
    assert run().count("a") == got.count("a") + 1


def test_watermark_form(spark, tmp_path):
    raw_events(spark, SF).write.parquet(str(tmp_path / "in"))
    s = dedup.within_watermark(event_stream(spark, str(tmp_path / "in")))
    q = s.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert spark.table("once").count() == raw_events(spark, SF).select("event_id").distinct().count()


def test_latency_join(spark, tmp_path):
    t = "event_id string, sent_at timestamp"
    sec = datetime.timedelta(seconds=1)
    spark.createDataFrame([("a", NOW), ("b", NOW), ("c", NOW)], t).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame([("a", NOW + sec), ("b", NOW + 301 * sec), ("c", NOW)], t.replace("sent", "received")).write.parquet(str(tmp_path / "r"))
    read = lambda name, s: spark.readStream.schema(s).parquet(str(tmp_path / name))
    q = pipeline.latency(read("s", t), read("r", t.replace("sent", "received"))).writeStream.format("memory").queryName("lat").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert [tuple(r) for r in spark.table("lat").collect()] == [("a", 1000.0)]


def test_decode(spark):
    good = b'{"event_id":"e1","price":1.5}'
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 678_000)
    millis = int(at.replace(tzinfo=datetime.UTC).timestamp() * 1000)
    record = ["é1", "s", millis, "REFUND", "web", "1.2.3.4", None, "p", None, -3, 2.5, None]
    framed = b"\x00\x00\x00\x00\x07" + write_avro(record)
    df = spark.createDataFrame([(good,), (b"\x00\x00\x00\x00\x07" + good,), (b"not json",), (framed,), (framed[:-3],), (framed + b"x",), (b"\x00\x00\x00\x00\x07\xff\xff",), (None,), (b"",)], "value binary")
    events, errors = decode(df)
    out = {r["event_id"]: r for r in events.collect()}
    assert events.count() == 3 and out["e1"]["price"] == 1.5
    r = out["é1"]
    assert (r["event_time"], r["event_type"], r["user_id"], r["quantity"], r["price"]) == (at, "REFUND", None, -3, 2.5)
    bad = [r["raw_message"] for r in errors.collect()]
    assert len(bad) == 6 and "not json" in bad and framed[:-3].hex() in bad
    short = AVRO_FIELDS[:6]
    some, none = decode(spark.createDataFrame([(b"\x00\x00\x00\x00\x01" + write_avro(record[:6], short),), (framed,)], "value binary"), schemas={1: short})
    assert [(r["event_id"], r["price"]) for r in some.collect()] == [("é1", None)] and "no schema 7" in none.first()["error"]


def test_avro_records():
    rng = __import__("random").Random(3)
    pick = {"string": lambda: "".join(rng.choice("abé😀 ") for _ in range(rng.randint(0, 80))), "millis": lambda: rng.randint(-(1 << 62), 1 << 62), "enum": lambda: rng.choice(AVRO_SYMBOLS), "int": lambda: rng.randint(-(1 << 31), (1 << 31) - 1), "double": rng.random}
    for _ in range(500):
        record = [None if kind.endswith("?") and rng.random() < 0.3 else pick[kind.rstrip("?")]() for _, kind in AVRO_FIELDS]
        data = write_avro(record)
        assert read_avro(data) == record
        for cut in (data[: rng.randrange(len(data))], data + b"\0"):
            with pytest.raises((ValueError, IndexError, __import__("struct").error)):
                read_avro(cut)


def test_decode_errors_are_kept_by_month(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for day in ("2024-01-10", "2024-02-20"):
        store_errors(store, spark.createDataFrame([(datetime.datetime.fromisoformat(day), "x", "y")], "captured_at timestamp, error string, raw_message string"))
    assert purge_errors(store, datetime.date(2024, 3, 1)) == [] and purge_errors(store, datetime.date(2024, 3, 2), dry_run=True) == ["2024-01"]
    assert purge_errors(store, datetime.date(2024, 3, 2)) == ["2024-01"] and [r["month"] for r in store.read("decode_errors").collect()] == ["2024-02"]


def test_kafka_says_what_is_missing(spark):
    try:
        kafka_stream(spark, "localhost:1", "raw")
    except RuntimeError as e:
        assert "class path" in str(e)
