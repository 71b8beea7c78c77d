"""Validation, normalisation and dead letters, case by case."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import clean as C
from tributary.schema import EVENT

NOW = datetime.datetime(2024, 1, 16, 12)
BASE = dict(event_id="evt-001", session_id="sess-abc", event_time=NOW, event_type="VIEW", device="web", ip="203.0.113.42", user_id="USR-00001", product_id="ELEC-001", category="electronics", quantity=1, price=29999.0, payment_mode="credit_card")


def rows(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}[f.name] for f in EVENT) for c in changes], EVENT)


def reasons(spark, *changes):
    return [r["reason"] for r in C.tagged(rows(spark, *changes), NOW, 48).select("reason").collect()]


@pytest.mark.parametrize("field", ["event_id", "session_id", "event_type", "device", "ip", "event_time"])
def test_required_fields(spark, field):
    assert reasons(spark, {field: None}) == [f"missing required field: {field}"]


@pytest.mark.parametrize("field", ["event_id", "session_id", "device", "ip"])
def test_blank_is_missing(spark, field):
    assert reasons(spark, {field: " \t "}, {field: ""}) == [f"missing required field: {field}"] * 2


def test_first_rule_wins(spark):
    assert reasons(spark, {"event_id": None, "ip": None, "quantity": -1}) == ["missing required field: event_id"]


def test_ranges(spark):
    assert reasons(spark, {"quantity": -1}, {"quantity": 0}, {"price": -0.01}, {"price": 0.0}, {"price": -1e10}) == ["quantity must be >= 0, got: -1", None, "price must be >= 0, got: -0.01", None, "price must be >= 0, got: -1.0E10"]


def test_freshness(spark):
    h = datetime.timedelta(hours=1)
    got = reasons(spark, *[{"event_time": NOW + k * h} for k in (-47, 48, -49, 49)], {"event_time": datetime.datetime(1970, 1, 1)})
    assert got[:2] == [None, None]
    assert got[2] == "event_time out of ±48h window: 2024-01-14T11:00:00.000Z (now=2024-01-16T12:00:00.000Z)"
    assert all("event_time" in r for r in got[2:])


def test_normalised(spark):
    got = C.clean(rows(spark, {"event_id": "  evt-001  ", "session_id": "\tsess-abc\t", "category": " ELECTRONICS ", "payment_mode": " upi"}, {"category": None}), NOW, 48).collect()
    assert (got[0]["event_id"], got[0]["session_id"], got[0]["category"], got[0]["payment_mode"]) == ("evt-001", "sess-abc", "electronics", "upi")
    assert got[1]["category"] is None


def test_devices(spark):
    names = ["Browser", "Desktop", "PWA", "iOS", "iPhone", "iPad", "ios_app", "Android_App", "SmartTV", "", None, " web "]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, d string")
    assert [r["d"] for r in df.select("i", C.device(F.col("d")).alias("d")).orderBy("i").collect()] == ["web", "web", "web", "ios", "ios", "ios", "ios", "android", "other", "other", "other", "web"]


def test_dead_letters(spark):
    raw = rows(spark, {}, {"event_id": None, "category": 'a"b\\c\n'}, {})
    letters = C.dead_letters(raw, F.lit(5).cast("bigint"), NOW, 48).collect()
    assert len(letters) == 1 and C.clean(raw, NOW, 48).count() == 2
    payload = json.loads(letters[0]["raw_payload"])
    assert payload["event_id"] is None and payload["category"] == 'a"b\\c\n' and len(payload) == 12
    one = json.loads(C.envelope(C.dead_letters(raw, F.lit(5).cast("bigint"), NOW, 48)).first()["value"])
    assert list(one) == ["reason", "raw_payload", "ingest_ts"] and one["ingest_ts"] == 5
    assert C.dead_letters(raw, F.lit(5), NOW, 48, layout="compact").columns == ["reason", "event_id", "ingest_ts"]


