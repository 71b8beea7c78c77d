"""Deduplication: sequences of repeats, time to live, versions and upserts."""

import datetime

import pytest
from pyspark.sql import functions as F

from tributary.operators import dedup as D

T0 = datetime.datetime(2024, 1, 1)


def events(spark, arrivals):
    return spark.createDataFrame([(i, T0 + datetime.timedelta(minutes=m)) for i, m in arrivals], "event_id string, event_time timestamp")


@pytest.mark.parametrize(
    ("ids", "kept"),
    [(["001"], 1), (["001"] * 2, 1), (["001"] * 3, 1), (["A", "B"], 2), (["001", "002", "001", "003", "002"], 3), ([f"{i}" for i in range(100)], 100), (["001"] * 100, 1)],
)
def test_sequences(spark, ids, kept):
    e = events(spark, [(x, k / 100) for k, x in enumerate(ids)])
    assert D.first_seen(e).count() == kept == D.first_per_id(e).count()


def test_ttl(spark):
    e = events(spark, [("a", 0), ("a", 119), ("a", 121), ("b", 0), (None, 0), (None, 0)])
    assert sorted((r["event_id"] or "", r["event_time"].hour * 60 + r["event_time"].minute) for r in D.first_seen(e).collect()) == [("", 0), ("", 0), ("a", 0), ("a", 121), ("b", 0)]
    assert D.first_seen(e, extend_on_duplicate=True).where("event_id = 'a'").count() == 1


@pytest.mark.parametrize("hours", [0, -1])
def test_window_must_be_positive(spark, hours):
    with pytest.raises(ValueError, match="windowHours"):
        D.first_seen(events(spark, [("a", 0)]), ttl_hours=hours)


def test_latest_version(spark):
    v = spark.createDataFrame([("VIEW", "c", 1, "e", 1), ("VIEW", "c", 1, "e", 2), ("VIEW", None, 1, "e", 1), ("VIEW", None, 1, "e", 3)], "event_type string, category string, event_time int, event_id string, ingest_ts int")
    assert sorted(r["ingest_ts"] for r in D.latest_version(v).collect()) == [2, 3]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "event_id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "event_id string, v int")
    once = D.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2), ("c", 2)] == sorted(map(tuple, D.upsert(once, new).collect()))


def test_end_to_end_counts(spark):
    e = spark.range(1000).select(F.concat(F.lit("evt-"), "id").alias("event_id"), F.lit(T0).alias("event_time"))
    sent = e.unionByName(e.limit(100).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 MINUTE")))
    assert D.first_seen(sent).count() == 1000 and D.first_per_id(sent).exceptAll(e).count() == 0
