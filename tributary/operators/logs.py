"""Log and metric lines to records: ordered patterns, details, levels and tags; a line that fits no pattern stays, tagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVELS = "TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL"
#: By service: patterns in the order that they are tried, each with the group of its parts; 0 stands for none.
PATTERNS = {
    "stream": (
        (rf"^(\d{{4}}-\d\d-\d\d[ T]\d\d:\d\d:\d\d[.,]\d{{3}})\s+({_LEVELS})\s+\[([^\]]*)\]\s+(\S+)(?:\s+\[[^\]]*\])?\s+-\s+(.*)$", {"time": 1, "level": 2, "thread": 3, "logger": 4, "body": 5}),
        (rf"^(\d{{4}}-\d\d-\d\d[ T]\d\d:\d\d:\d\d[.,]\d{{3}})\s+({_LEVELS})\s+(.*)$", {"time": 1, "level": 2, "body": 3}),
    ),
    "broker": (
        (rf"^\[(\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d,\d{{3}})\]\s+({_LEVELS})\s+\[([^\]]*)\]\s*:?\s*(.*?)\s+\(([\w.$]+)\)$", {"time": 1, "level": 2, "thread": 3, "body": 4, "logger": 5}),
        (rf"^\[(\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d,\d{{3}})\]\s+({_LEVELS})\s+(.*?)\s+\(([\w.$]+)\)$", {"time": 1, "level": 2, "body": 3, "logger": 4}),
        (rf"^\[(\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d,\d{{3}})\]\s+({_LEVELS})\s+(.*)$", {"time": 1, "level": 2, "body": 3}),
    ),
    "store": (
        (r"^(\d{4}\.\d\d\.\d\d \d\d:\d\d:\d\d\.\d+)\s+\[\s*(\d+)\s*\]\s+\{([^}]*)\}\s+<(\w+)>\s+([^:]+):\s+(.*)$", {"time": 1, "thread": 2, "query": 3, "level": 4, "logger": 5, "body": 6}),
        (r"^(\d{4}\.\d\d\.\d\d \d\d:\d\d:\d\d\.\d+)\s+\[\s*(\d+)\s*\]\s+<(\w+)>\s+(.*)$", {"time": 1, "thread": 2, "level": 3, "body": 4}),
        (r"^(\d{4}\.\d\d\.\d\d \d\d:\d\d:\d\d\.\d+)\s+<(\w+)>\s+(.*)$", {"time": 1, "level": 2, "body": 3}),
    ),
}
PARTS = ("time", "level", "thread", "logger", "query", "body")
#: Other names of levels.
LEVEL_NAMES = {"information": "info", "warning": "warn", "severe": "error", "fine": "debug", "notice": "info", "critical": "fatal"}


def service(container: Column) -> Column:
    return F.when(container.rlike("(?i)flink|jobmanager|taskmanager"), "stream").when(container.rlike("(?i)kafka|broker|zookeeper"), "broker").when(container.rlike("(?i)clickhouse|store"), "store").otherwise("other")


def role(container: Column) -> Column:
    return F.when(container.rlike("(?i)jobmanager"), "coordinator").when(container.rlike("(?i)taskmanager"), "worker").when(container.rlike("(?i)kafka"), "broker").when(container.rlike("(?i)clickhouse"), "store")


def level(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in LEVEL_NAMES.items() for x in pair]), low), low)


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group's text, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def parse(lines: DataFrame) -> DataFrame:
    """lines (container, message) -> service, role, parts, details, ts, level, tags. First pattern that matches wins; JSON lines are told by their brace."""
    m = F.col("message")
    out = lines.withColumn("service", service(F.col("container"))).withColumn("role", role(F.col("container"))).withColumn("is_json", F.coalesce(m.startswith("{"), F.lit(False)))
    fields = "level string, loggerName string, message string, thread string, instant struct<epochSecond:bigint,nanoOfSecond:bigint>, mdc struct<jobId:string,taskName:string>"
    out = out.withColumn("json", F.when(F.col("is_json"), F.from_json(m, fields)))
    # which pattern fits is told once, so that none is tried again for each part
    forms = [(name, pattern, groups) for name, patterns in PATTERNS.items() for pattern, groups in patterns]
    form = F.when(F.lit(False), F.lit(None).cast("int"))
    for name in PATTERNS:
        own = F.when(F.lit(False), F.lit(None).cast("int"))
        for k, (of, pattern, _) in enumerate(forms):
            own = own.when(m.rlike(pattern), k) if of == name else own
        form = form.when(F.col("service") == name, own)
    out = out.withColumn("form", form)
    parts = {}
    for part in PARTS:
        own = F.when(F.lit(False), F.lit(None).cast("string"))
        for k, (_, pattern, groups) in enumerate(forms):
            own = own.when(F.col("form") == k, F.regexp_extract(m, pattern, groups[part])) if part in groups else own
        parts[part] = F.nullif(own, F.lit(""))
    out = out.withColumns(parts)
    j = F.col("json")
    out = out.withColumns({"level": F.coalesce(j["level"], F.col("level")), "logger": F.coalesce(j["loggerName"], F.col("logger")), "thread": F.coalesce(j["thread"], F.col("thread")), "body": F.coalesce(j["message"], F.col("body"))})
    text = F.regexp_replace(F.regexp_replace(F.col("time"), "[T]", " "), ",", ".")
    text = F.regexp_replace(text, r"^(\d{4})\.(\d\d)\.(\d\d)", "$1-$2-$3")
    ts = F.coalesce(F.timestamp_micros(j["instant"]["epochSecond"] * 1_000_000 + F.call_function("div", j["instant"]["nanoOfSecond"], F.lit(1000))), text.try_cast("timestamp"))
    failed = F.col("body").isNull()
    body = F.coalesce(F.col("body"), m)
    thread = r"^(.*?)\s*\((\d+)/(\d+)\)"
    out = out.withColumns({
        "ts": ts, "level": level(F.col("level")), "failed": failed, "text": body,
        "task": found(F.col("thread"), thread, 1), "subtask": found(F.col("thread"), thread, 2).cast("int"), "parallelism": found(F.col("thread"), thread, 3).cast("int"),
        "job_id": found(body, r"(?i)\bjob ([0-9a-f]{32})\b"), "checkpoint_id": found(body, r"(?i)\bcheckpoint (\d+)").cast("bigint"), "watermark": found(body, r"(?i)\bwatermark (-?\d+)").cast("bigint"),
        "topic_partition": found(body, r"\b([\w.-]+-\d+)\b"), "leader_id": found(body, r"(?i)leader\.?id\s*[=:]\s*(\d+)").cast("int"),
        "topic": F.coalesce(found(body, r"(?i)\btopic ([\w.-]+)"), found(body, r"\b([A-Za-z][\w.-]*)-\d+\b")), "partition": F.coalesce(found(body, r"(?i)\bpartition (\d+)"), found(body, r"\b[A-Za-z][\w.-]*-(\d+)\b")).cast("int"),
        "offset": found(body, r"(?i)\b(?:high.?watermark|lastStableOffset|LSO)\s*[=:]\s*(\d+)").cast("bigint"), "isr": found(body, r"(?i)\bISR\b[^\d]*([0-9]+(?:, ?[0-9]+)*)"), "task_name": found(body, r"(?i)\btask '([^']{3,64})'"), "database_table": found(body, r"\b([a-z_]\w*\.[a-z_]\w*)\b"),
        "elapsed_ms": F.round(found(body, r"\bin ([0-9.]+) sec").try_cast("double") * 1000).cast("bigint"), "rows": found(body, r"(?i)\b(\d+) rows").cast("bigint"),
    })
    own = F.col("service")
    tags = {
        "parse_failure": F.col("failed"),
        "checkpoint_failure": body.rlike(r"(?i)checkpoint.*(fail|declin|expired|abort)"),
        "checkpoint_triggered": body.rlike(r"(?i)trigger\w* checkpoint"),
        "backpressure": body.rlike(r"(?i)back-?pressure"),
        "application_error": F.col("level").isin("error", "fatal"),
        "leader_election": (own == "broker") & body.rlike(r"(?i)leader elect|elected (as )?(the )?leader|new leader"),
        "isr_change": (own == "broker") & body.rlike(r"(?i)(shrinking|expanding) isr|\bISR\b"),
        "under_replicated": (own == "broker") & body.rlike(r"(?i)under-?replicated"),
        "slow_query": (own == "store") & (F.col("elapsed_ms") > 5000),
        "complex_query": (own == "store") & (F.length(body) >= 500),
        "materialized_view": (own == "store") & body.rlike(r"(?i)materialized view|_mv\b"),
        "deduplication": body.rlike(r"(?i)dedup"),
        "stack_trace": m.rlike(r"(?m)^\s+at [\w.$]+\(|Exception"),
    }
    out = out.withColumn("tags", F.array_compact(F.array(*[F.when(cond, name) for name, cond in tags.items()])))
    return out.select("container", "service", "role", "is_json", "ts", "level", "thread", "logger", "text", "task", "subtask", "parallelism", "job_id", "checkpoint_id", "watermark", "topic_partition", "leader_id", "topic", "partition", "offset", "isr", "task_name", "database_table", "elapsed_ms", "rows", "tags")


#: Alerts by name: metric and limit.
ALERTS = {
    "high_cpu": ("cpu_total_pct", ">", 80.0), "high_memory": ("memory_pct", ">", 85.0), "high_lag": ("lag", ">", 10_000.0), "no_running_jobs": ("running_jobs", "=", 0.0), "store_memory": ("memory_bytes", ">", 3.5 * (1 << 30)),
}


def alerts(metrics: DataFrame) -> DataFrame:
    """metrics (module, host, cpu_user_pct, cpu_system_pct, memory_pct, lag, running_jobs, memory_bytes) with `alerts`, and the index that they go to."""
    m = metrics.withColumn("cpu_total_pct", F.coalesce("cpu_user_pct", F.lit(0.0)) + F.coalesce("cpu_system_pct", F.lit(0.0)))
    hit = {n: (F.col(c) > limit) if side == ">" else (F.col(c) == limit) for n, (c, side, limit) in ALERTS.items()}
    return m.withColumn("alerts", F.array_compact(F.array(*[F.when(cond, n) for n, cond in hit.items()])))


def routed(records: DataFrame, prefix: str = "metrics") -> DataFrame:
    """Adds the index name <prefix>-<module>-<YYYY.MM.dd>."""
    return records.withColumn("index", F.concat_ws("-", F.lit(prefix), F.coalesce("module", F.lit("other")), F.date_format("ts", "yyyy.MM.dd")))


def sustained(points: DataFrame, value: str, limit: float, minutes: int = 5) -> DataFrame:
    """Tumbling windows in which all of a host's points are over the limit."""
    g = points.groupBy("host", F.window("ts", f"{minutes} minutes")["start"].alias("window_start")).agg(F.min(value).alias("least"), F.count(F.lit(1)).alias("points"))
    return g.where(F.col("least") > limit)


def frequent(points: DataFrame, condition: Column, times: int = 3, minutes: int = 5) -> DataFrame:
    """Tumbling windows in which a condition holds at least so often, as checkpoint failures do."""
    return points.where(condition).groupBy(F.window("ts", f"{minutes} minutes")["start"].alias("window_start")).agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= times)


def dead_letter_rate(judged: DataFrame, time: str = "event_time", limit: float = 0.01, minutes: int = 5) -> DataFrame:
    """Tumbling windows in which more than `limit` of the judged events (with their `reason`) are rejected."""
    g = judged.groupBy(F.window(time, f"{minutes} minutes")["start"].alias("window_start")).agg(F.count(F.lit(1)).alias("events"), F.count("reason").alias("rejected"))
    return g.where(F.col("rejected") > F.col("events") * limit)
