"""Statistics of load tests: percentiles, rates, phases and service levels."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.scratch import stage

#: Service levels by name: phase, measure, whether it is to be above or below, and the target.
SLOS = (
    ("warmup_p99", "warmup", "latency_p99_mean", "below", 500.0),
    ("steady_low_p99", "steady_low", "latency_p99_mean", "below", 1000.0),
    ("steady_mid_p95", "steady_mid", "latency_p95_mean", "below", 2000.0),
    ("steady_high_p95", "steady_high", "latency_p95_mean", "below", 5000.0),
    ("steady_low_rate", "steady_low", "produce_rate_mean", "above", 9000.0),
    ("steady_high_rate", "steady_high", "produce_rate_mean", "above", 72000.0),
    ("checkpoint_ms", "steady_low", "checkpoint_max_ms", "below", 30000.0),
    ("lag", "steady_low", "lag_max", "below", 50000.0),
    ("recovery_s", "recovery", "recovery_s", "below", 90.0),
)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows in a total order over range partitions, staged, with _id: the partition's number (from bit 33 on) and the place in it."""
    return stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "placed")


def indexed_percentiles(rows: DataFrame, group: list[str], value: str, shares: tuple[float, ...] = (50, 95, 99)) -> DataFrame:
    """The value at place floor(n p / 100) (from 0, the last at most) of each group's sorted values.

    Values are sorted over all tasks, whatever their groups; a group's places are found from how many of its values each
    partition holds, and only the rows at these places are looked up.
    """
    placed = _placed(rows.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v")), [*group, "_v"])
    held = placed.groupBy(*group, F.shiftright("_id", 33).alias("_part")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.withColumn("_before", before).withColumn("samples", F.sum("_n").over(w))  # a row per group and partition that it is in
    asked = held.withColumn("_share", F.explode(F.array(*[F.lit(float(p)) for p in shares])))
    asked = asked.withColumn("_at", F.least(F.floor(F.col("samples") * F.col("_share") / 100), F.col("samples") - 1))
    asked = asked.where("_before <= _at and _at < _before + _n").select((F.col("_first") + F.col("_at") - F.col("_before")).alias("_id"), "_share", "samples")
    found = placed.join(asked, "_id")
    return found.groupBy(*group).agg(F.first("samples").alias("samples"), *[F.max(F.when(F.col("_share") == float(p), F.col("_v"))).alias(f"p{p:g}") for p in shares])


def positive_mean(c: str) -> Column:
    """Mean of what is over zero; null, not 0, if there is none."""
    return F.avg(F.when(F.col(c) > 0, F.col(c)))


def rates(rows: DataFrame, counter: str, time: str, partition: list[str]) -> DataFrame:
    """Growth of a counter per second since the row before.

    Rows are sorted over all tasks; the row before is looked for within a partition, and at its edge among the last rows of
    those before, so a series of any length is not one task's.
    """
    placed = _placed(rows, [*partition, time, counter]).withColumn("_part", F.shiftright("_id", 33))
    now = F.struct(F.col(time).alias("t"), F.col(counter).alias("c"))
    last = placed.groupBy(*partition, "_part").agg(F.max_by(now, "_id").alias("_now"))
    edge = last.select(*partition, "_part", F.lag("_now").over(Window.partitionBy(*partition).orderBy("_part")).alias("_edge"))
    before = F.coalesce(F.lag(now).over(Window.partitionBy(*partition, "_part").orderBy("_id")), F.col("_edge"))
    own = placed.join(edge.withColumnsRenamed({c: f"_{c}_of" for c in [*partition, "_part"]}), reduce(and_, [placed[c].eqNullSafe(F.col(f"_{c}_of")) for c in [*partition, "_part"]]))
    own = own.withColumn("_before", before)
    seconds = (F.unix_micros(time) - F.unix_micros(F.col("_before.t"))) / 1e6
    return own.withColumn("rate", (F.col(counter) - F.col("_before.c")) / F.nullif(seconds, F.lit(0.0))).select(*rows.columns, "rate")


#: Measures that are means of what is over zero, by the column that they are of.
MEANS = {
    "produce_rate_mean": "actual_produce_rate", "consume_rate_mean": "actual_consume_rate", "latency_p50_mean": "latency_p50_ms", "latency_p95_mean": "latency_p95_ms", "latency_p99_mean": "latency_p99_ms",
    "lag_mean": "kafka_lag", "checkpoint_mean_ms": "checkpoint_duration_ms", "checkpoint_size_mean_mb": "checkpoint_size_mb", "coordinator_cpu_mean": "flink_jm_cpu_pct", "coordinator_memory_mean_mb": "flink_jm_mem_mb",
    "worker_cpu_mean": "flink_tm1_cpu_pct", "worker_memory_mean_mb": "flink_tm1_mem_mb", "broker_cpu_mean": "kafka1_cpu_pct", "broker_memory_mean_mb": "kafka1_mem_mb",
}


def phase_stats(metrics: DataFrame) -> DataFrame:
    """A row per phase. Each row of metrics tells how many errors it saw, so they are summed; a mean or maximum of nothing is null, not 0."""
    top = lambda c: F.max(F.when(F.col(c) >= 0, F.col(c)))
    stats = metrics.groupBy("phase").agg(
        F.min("target_rate").alias("target_rate"), F.count(F.lit(1)).alias("rows"), *[positive_mean(c).alias(name) for name, c in MEANS.items()], top("actual_produce_rate").alias("produce_rate_max"),
        top("latency_max_ms").alias("latency_max"), F.sum("latency_samples").alias("latency_samples"), top("kafka_lag").alias("lag_max"), top("checkpoint_duration_ms").alias("checkpoint_max_ms"), F.sum("errors").alias("errors"),
        F.max(F.regexp_extract("flink_job_status", r"RECOVERED_IN_([0-9.]+)s", 1).try_cast("double")).alias("recovery_s"),
    )
    p95 = indexed_percentiles(metrics.where("actual_produce_rate > 0"), ["phase"], "actual_produce_rate", (95,)).select(F.col("phase").alias("_phase"), F.col("p95").alias("produce_rate_p95"))
    return stats.join(p95, F.col("phase").eqNullSafe(F.col("_phase")), "left").drop("_phase")


def evaluate(stats: DataFrame, slos=SLOS) -> DataFrame:
    """slo, phase, measure, target, actual, verdict: PASS, FAIL, or NO DATA where there is no phase or no value."""
    spark: SparkSession = stats.sparkSession
    targets = spark.createDataFrame(list(slos), "slo string, phase string, measure string, side string, target double")
    names = sorted({s[2] for s in slos})
    long = stats.select("phase", F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names]))).alias("measure", "actual"))
    ok = F.when(F.col("side") == "below", F.col("actual") <= F.col("target")).otherwise(F.col("actual") >= F.col("target"))
    out = targets.join(long, ["phase", "measure"], "left")
    return out.select("slo", "phase", "measure", "target", "actual", F.when(F.col("actual").isNull(), "NO DATA").when(ok, "PASS").otherwise("FAIL").alias("verdict"))
