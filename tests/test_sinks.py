"""Rows, JSON and CSV in and out; replay; the entry module without the text operators."""

import datetime
import json
import subprocess
import sys
from pathlib import Path

from tributary.sources import sinks
from tributary.sources.events import METRICS, decode_table, metrics_csv
from tributary.streaming import pipeline
from tributary.streaming.store import Store

NOW = datetime.datetime(2024, 1, 16, 12)


def test_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "it's")], "id int, name string")
    assert sinks.run_sql(spark, "select * from t where name = :n", {"n": "it's"}, {"t": df}) == [{"id": 2, "name": "it's"}]
    assert sorted(r["id"] for r in sinks.iterate(df)) == [1, 2]
    assert sinks.table_form(df.orderBy("id")) == [["id", "name"], [1, "a"], [2, "it's"]] and sinks.table_form(df.limit(0)) == []
    assert sinks.cache_key("q", b=2, a=1) == sinks.cache_key("q", a=1, b=2) != sinks.cache_key("q", a=1, b=3)


def test_json(spark, tmp_path):
    path = sinks.write_json(spark, str(tmp_path), {"ok": True, "at": NOW}, NOW)
    assert path.endswith("/2024/01/16/12/result.json") and json.loads(Path(path).read_text())["ok"]


def test_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("phase,rate,lag\nwarmup,1.5,3\nbad,x,y\nsteady,,\n")
    rows, malformed = decode_table(spark, str(tmp_path / "m.csv"), "phase string, rate double, lag int")
    assert [tuple(r) for r in rows.collect()] == [("warmup", 1.5, 3), ("steady", None, None)] and [r["line"] for r in malformed.collect()] == ["bad,x,y"]
    sinks.write_metrics_csv(rows, str(tmp_path / "out"))
    assert decode_table(spark, str(tmp_path / "out"), "phase string, rate double, lag int")[0].count() == 2


def test_metrics_csv(spark, tmp_path):
    """Blanks are 0, a blank lag is -1; lines that do not fit are counted."""
    names = [f.split(" ")[0] for f in METRICS.split(", ")]
    line = lambda **v: ",".join(str(v.get(n, "")) for n in names)
    (tmp_path / "m.csv").write_text("\n".join([",".join(names), line(ts="t", phase="warmup", actual_produce_rate=1.5, kafka_lag=7), line(ts="t", phase="steady"), line(ts="t", phase="x", errors="many")]) + "\n")
    rows, malformed = metrics_csv(spark, str(tmp_path / "m.csv"))
    got = {r["phase"]: r for r in rows.collect()}
    assert (got["warmup"]["kafka_lag"], got["steady"]["kafka_lag"], got["steady"]["actual_produce_rate"], got["steady"]["errors"], got["steady"]["flink_job_status"]) == (7, -1, 0.0, 0, "")
    assert malformed.count() == 1 and "x" not in got


def test_replay(spark, tmp_path):
    from tributary.sources.events import event_stream, raw_events

    raw_events(spark, "/root/testdata/sf0.001").limit(200).write.parquet(str(tmp_path / "in"))
    out, counts = Store(spark, str(tmp_path / "out")), []
    for _ in range(2):
        sinks.empty(spark, out.root, str(tmp_path / "cp"))
        q = pipeline.start(event_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "cp"), max_skew_hours=None, available_now=True, dedup_hours=None)
        assert q.awaitTermination(120)
        counts.append(out.read("events").count() + out.read("dead_letters").count())
    assert counts == [200, 200]


def test_newest_first(spark):
    e = lambda *ids: spark.createDataFrame([(i, NOW + datetime.timedelta(minutes=i)) for i in ids], "id int, event_time timestamp")
    assert [r["id"] for r in sinks.newest_first(e(1, 2), e(9, 2), 3).collect()] == [2, 1, 9]


def test_without_text_operators(tmp_path):
    """The entry module works where the subpackage and its pipeline are gone."""
    import shutil

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "tributary", tmp_path / "tributary", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and 'revenue_by_category' in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)


def test_missing_libraries_are_told(tmp_path):
    """A library that the text operators need is no reason to leave them out in silence."""
    import shutil

    root = Path(__file__).resolve().parent.parent
    if not (root / "corpus_pipeline.py").exists():
        return
    shutil.copytree(root / "tributary", tmp_path / "tributary", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(root / name, tmp_path)
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120, capture_output=True, text=True)
    assert run.returncode and "xxhash" in run.stderr
