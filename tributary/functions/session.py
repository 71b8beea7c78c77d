"""Session settings that the queries rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: The JVM does not compile methods beyond so many bytes of code; Spark's own limit for one generated method is far above that,
#: so wide projections would be interpreted. Beyond this limit they are cut into smaller methods instead.
COMPILED_BYTES = 8_000


def tune(spark: SparkSession) -> SparkSession:
    """Reads time stamps without a zone as UTC and keeps generated code within what the JVM compiles."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """What is made and run in it is planned adaptively, without which hints to rebalance are void: the session of a stream's batches has that switched off."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
