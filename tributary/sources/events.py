"""Readers of raw events, and the view of the driver's `events` table as raw events."""

from __future__ import annotations

import datetime
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.scratch import stage
from tributary.functions.ship import ship
from tributary.schema import EVENT

#: Names that the adapter deals out.
RAW_DEVICES = ("web", "Browser", "iPhone", "Android_App", "PWA", "SmartTV", "iPad")
CATEGORIES = ("electronics", "fashion", "home", "beauty", "sports", "books", "toys", "grocery", "automotive", "garden")
PAYMENT_MODES = ("credit_card", "debit_card", "upi", "net_banking", "wallet", "cod", "emi")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(names: tuple[str, ...], place) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (place + 1).cast("int"))


def raw_events(spark: SparkSession, sf_dir: str, since: datetime.datetime | None = None) -> DataFrame:
    """The driver's events as raw clickstream events; every tenth is sent again a minute later. since: the least time of what is read, which the scan is told."""
    e = table(spark, sf_dir, "events")
    if since is not None:
        e = e.where(F.col("ts") >= F.lit(since - datetime.timedelta(minutes=1)).cast("timestamp_ntz"))
    e = e.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("bigint"))
    i, k = F.col("event_id"), F.col("k")
    kind = (
        F.when(F.col("event_type") == "view", F.when(i % 5 == 0, "WISHLIST").otherwise("VIEW"))
        .when(F.col("event_type") == "click", F.when(i % 4 == 0, "REMOVE_CART").otherwise("ADD_TO_CART"))
        .when(F.col("event_type") == "signup", F.when(i % 6 == 0, "ORDER_CANCELLED").otherwise("ORDER_CREATED"))
        .when(F.col("event_type") == "purchase", F.when(i % 8 == 0, "REFUND").otherwise("PAYMENT_SUCCESS"))
        .otherwise("PAYMENT_FAILED")
    )
    e = e.withColumn("kind", kind)
    sells, pays = ~F.col("kind").isin("VIEW", "WISHLIST", "REMOVE_CART"), F.col("kind").isin("ORDER_CREATED", "PAYMENT_SUCCESS", "PAYMENT_FAILED", "REFUND")
    sign = F.when(i % 97 == 0, -1).otherwise(1)
    name = _nth(CATEGORIES, k % 10)
    time = F.col("ts").cast("timestamp")
    base = e.select(
        i.cast("string").alias("event_id"),
        F.concat(F.lit("sess-"), F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        time.alias("event_time"),
        F.col("kind").alias("event_type"),
        _nth(RAW_DEVICES, i % 7).alias("device"),
        F.concat(F.lit("10.0."), (i % 256).cast("string"), F.lit("."), (k % 256).cast("string")).alias("ip"),
        F.when(i % 10 >= 3, F.concat(F.lit("USR-"), F.lpad(F.col("user_id").cast("string"), 5, "0"))).alias("user_id"),
        F.when(k % 23 != 0, F.concat(F.lit("SKU-"), (k % 100).cast("string"))).alias("product_id"),
        F.when(k % 23 != 0, F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper(name), F.lit(" "))).otherwise(name)).alias("category"),
        F.when(sells, ((1 + k % 3) * sign)).cast("int").alias("quantity"),
        F.when(sells, F.col("value") * sign).alias("price"),
        F.when(pays, _nth(PAYMENT_MODES, i % 7)).alias("payment_mode"),
    )
    again = base.where(F.col("event_id").cast("bigint") % 10 == 0).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 MINUTE"))
    every = base.unionByName(again)
    return every if since is None else every.where(F.col("event_time") >= F.lit(since))


def as_of(spark: SparkSession, sf_dir: str) -> datetime.datetime:
    """The last event's time: what `now` is for queries over recorded data. Reads one column."""
    return table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("t")).first()["t"]


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Raw events from a folder that files arrive in; what is read is remembered in the query's checkpoint."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_offsets: int = 500_000) -> DataFrame:
    """key, value, timestamp of a topic. Needs Spark's Kafka connector on the class path."""
    try:
        return (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting).option("maxOffsetsPerTrigger", max_offsets).load()
        )
    except Exception as e:
        raise RuntimeError("the Kafka connector (spark-sql-kafka) is not on the class path") from e


#: The record that the bytes of a message are of where they are not JSON: fields in order; ? may be null.
AVRO_FIELDS = (
    ("event_id", "string"), ("session_id", "string"), ("event_time", "millis"), ("event_type", "enum"), ("device", "string"), ("ip", "string"), ("user_id", "string?"), ("product_id", "string?"),
    ("category", "string?"), ("quantity", "int?"), ("price", "double?"), ("payment_mode", "string?"),
)
#: The event types, as they are numbered in such messages.
AVRO_SYMBOLS = ("VIEW", "ADD_TO_CART", "REMOVE_CART", "WISHLIST", "ORDER_CREATED", "PAYMENT_SUCCESS", "PAYMENT_FAILED", "ORDER_CANCELLED", "REFUND")


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A zigzag number of variable length, and where it ends."""
    shift = value = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7
        if shift > 63:
            raise ValueError("number too long")


def read_avro(data: bytes, at: int = 0, fields=AVRO_FIELDS, symbols=AVRO_SYMBOLS) -> list:
    """The values of one flat record. Raises an error if the bytes are no such record, or more than one."""
    out = []
    for name, kind in fields:
        if kind.endswith("?"):
            branch, at = _number(data, at)
            if branch not in (0, 1):
                raise ValueError(f"{name}: no branch {branch}")
            if branch == 0:
                out.append(None)
                continue
            kind = kind[:-1]
        if kind == "double":
            out.append(struct.unpack_from("<d", data, at)[0])
            at += 8
            continue
        n, at = _number(data, at)
        if kind == "string":
            if n < 0 or at + n > len(data):
                raise ValueError(f"{name}: {n} bytes at {at} of {len(data)}")
            out.append(data[at : at + n].decode())
            at += n
        elif kind == "enum":
            if not 0 <= n < len(symbols):
                raise ValueError(f"{name}: no symbol {n}")
            out.append(symbols[n])
        else:
            out.append(n)
    if at != len(data):
        raise ValueError(f"{len(data) - at} bytes too many")
    return out


def write_avro(values: list, fields=AVRO_FIELDS, symbols=AVRO_SYMBOLS) -> bytes:
    """The bytes that read_avro() reads."""
    out = bytearray()

    def number(n: int) -> None:
        n = (n << 1) ^ (n >> 63)
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        out.append(n)

    for (_, kind), v in zip(fields, values, strict=True):
        if kind.endswith("?"):
            number(int(v is not None))
            if v is None:
                continue
            kind = kind[:-1]
        if kind == "double":
            out += struct.pack("<d", v)
        elif kind == "string":
            number(len(v.encode()))
            out += v.encode()
        else:
            number(symbols.index(v) if kind == "enum" else v)
    return bytes(out)


_DECODED = ", ".join(f"{name} {'bigint' if kind == 'millis' else 'string' if kind in ('string', 'enum', 'string?') else kind.rstrip('?')}" for name, kind in AVRO_FIELDS) + ", error string, raw_message string, json string"


def _decoded(schemas: dict[int, tuple] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in AVRO_FIELDS]
        empty = [None] * len(names)
        kinds = [pa.int64() if k == "millis" else pa.float64() if k.startswith("double") else pa.int32() if k.startswith("int") else pa.string() for _, k in AVRO_FIELDS]
        for b in batches:
            rows = []
            for v in b["value"].to_pylist():
                if v is None or len(v) < 5 or v[0] != 0:
                    rows.append([*empty, None, None, None if v is None else v.decode("utf-8", "replace")])
                    continue
                number = int.from_bytes(v[1:5], "big")
                if v[5:6] == b"{":  # JSON within a frame
                    rows.append([*empty, None, None, v[5:].decode("utf-8", "replace")])
                    continue
                try:
                    if schemas is not None and number not in schemas:
                        raise ValueError(f"no schema {number}")
                    fields = AVRO_FIELDS if schemas is None else schemas[number]
                    got = dict(zip([n for n, _ in fields], read_avro(v, 5, fields), strict=True))
                    rows.append([*[got.get(n) for n in names], None, None, None])
                except (ValueError, IndexError, struct.error) as e:
                    rows.append([*empty, f"cannot be decoded: {e}", v.hex(), None])
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(names) + 3)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, [*kinds, *[pa.string()] * 3], strict=True)], [*names, "error", "raw_message", "json"])

    return run


def decode(messages: DataFrame, value: str = "value", schemas: dict[int, tuple] | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, errors) of messages: records framed by a zero byte and a 4-byte schema number, or JSON, framed or not.

    schemas: the fields by schema number, as AVRO_FIELDS has them for all numbers otherwise; columns are taken by name, those
    that a schema does not have are null. What cannot be read is an error row (captured_at, error, raw_message, in hex if it is
    no text); nothing is lost. Messages go to Python in Arrow batches.
    """
    ship(messages.sparkSession)
    read = messages.select(F.col(value).cast("binary").alias("value")).mapInArrow(_decoded(schemas), _DECODED)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT) + ", _corrupt string"
    parsed = read.withColumn("e", F.from_json("json", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    is_json = F.col("json").isNotNull()
    bad = F.col("error").isNotNull() | (is_json & (F.col("e").isNull() | F.col("e._corrupt").isNotNull())) | (~is_json & F.col("event_id").isNull())
    own = {f.name: F.timestamp_millis(f.name) if f.name == "event_time" else F.col(f.name) for f in EVENT}
    events = parsed.where(~bad).select(*[F.when(is_json, F.col(f"e.{name}")).otherwise(c).alias(name) for name, c in own.items()])
    errors = parsed.where(bad).select(F.current_timestamp().alias("captured_at"), F.coalesce("error", F.lit("cannot be decoded")).alias("error"), F.coalesce("raw_message", "json", F.lit("")).alias("raw_message"))
    return events, errors


def store_errors(store, errors: DataFrame) -> int:
    """Appends decode errors to their table, which is partitioned by month; months go as a whole (purge_errors)."""
    return store.append(errors.withColumn("month", F.date_format("captured_at", "yyyy-MM")), "decode_errors", "month")


def purge_errors(store, as_of: datetime.date, days: int = 30, dry_run: bool = False) -> list[str]:
    """Drops the months of decode errors whose last day is out of retention."""
    limit, gone = as_of - datetime.timedelta(days=days), []
    for e in store.state()["tables"].get("decode_errors", []):
        year, month = map(int, e["partition"].split("-"))
        last = datetime.date(year + month // 12, month % 12 + 1, 1) - datetime.timedelta(days=1)
        if last < limit:
            gone.append(e)
    if gone and not dry_run:
        store.commit(remove={"decode_errors": [e["path"] for e in gone]})
    return sorted({e["partition"] for e in gone})


def decode_table(spark: SparkSession, path: str, schema: str, blanks: dict[str, object] | None = None, **options: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines) of typed CSV without inference. blanks: by column, what a blank stands for."""
    rows = spark.read.csv(path, schema=f"{schema}, _corrupt string", header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", **options)
    rows = stage(rows, "csv")  # whether a line fits depends on which columns are asked for, so it is read once
    names = [c for c in rows.columns if c != "_corrupt"]
    good = rows.where(F.col("_corrupt").isNull()).select(*names)
    return good.fillna(blanks) if blanks else good, rows.where(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("line"))


#: The columns of a load test's metrics; blanks are 0, but for the lag, where they are -1 (not known).
METRICS = (
    "ts string, phase string, elapsed_sec double, target_rate int, produced_total bigint, consumed_total bigint, actual_produce_rate double, actual_consume_rate double, kafka_lag bigint, "
    "latency_p50_ms double, latency_p95_ms double, latency_p99_ms double, latency_max_ms double, latency_samples bigint, checkpoint_duration_ms bigint, checkpoint_size_mb double, checkpoint_count bigint, "
    "flink_jm_cpu_pct double, flink_jm_mem_mb double, flink_tm1_cpu_pct double, flink_tm1_mem_mb double, kafka1_cpu_pct double, kafka1_mem_mb double, flink_job_status string, errors bigint"
)


def metrics_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(metrics of a load test, malformed lines)."""
    numbers = [f.split(" ")[0] for f in METRICS.split(", ") if not f.endswith("string")]
    return decode_table(spark, path, METRICS, {n: -1 if n == "kafka_lag" else 0 for n in numbers} | {"flink_job_status": ""})
