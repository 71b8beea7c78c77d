"""Results to rows, JSON and files, and replay into an emptied target."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, views: dict[str, DataFrame] | None = None) -> list[dict]:
    """Rows of a query with named parameters (:name) as dicts; values are bound, never pasted in."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return [r.asDict(recursive=True) for r in spark.sql(sql, args=args or {}).collect()]


def iterate(df: DataFrame) -> Iterator[dict]:
    """Rows as dicts, a partition at a time, so that memory does not grow with the result."""
    for row in df.toLocalIterator(prefetchPartitions=True):
        yield row.asDict(recursive=True)


def table_form(df: DataFrame) -> list[list]:
    """A header and rows as lists; an empty list if there are no rows."""
    rows = df.collect()
    return [df.columns, *[list(r) for r in rows]] if rows else []


def cache_key(prefix: str, **params: Any) -> str:
    """The same for the same parameters in any order."""
    return f"{prefix}:{hashlib.md5('&'.join(f'{k}={params[k]}' for k in sorted(params)).encode()).hexdigest()}"


def write_json(spark: SparkSession, prefix: str, result: dict, at: datetime.datetime, name: str = "result", hourly: bool = True) -> str:
    """Writes prefix/YYYY/MM/DD[/HH]/name.json in whatever store the prefix names; returns the path."""
    path = f"{prefix.rstrip('/')}/{at:%Y/%m/%d}{f'/{at:%H}' if hourly else ''}/{name}.json"
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to, True)
    try:
        out.write(bytearray(json.dumps(result, ensure_ascii=False, default=str).encode()))
    finally:
        out.close()
    return path


def write_metrics_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def empty(spark: SparkSession, *paths: str) -> None:
    """Deletes targets and checkpoints before a replay from the earliest data."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def newest_first(live: DataFrame, polled: DataFrame, limit: int = 200) -> DataFrame:
    """Live rows before polled ones, newest first within each, the first `limit` of both; rows in both stay twice."""
    from pyspark.sql import functions as F

    both = live.withColumn("_side", F.lit(0)).unionByName(polled.withColumn("_side", F.lit(1)))
    return both.orderBy("_side", F.desc("event_time")).limit(limit).drop("_side")
