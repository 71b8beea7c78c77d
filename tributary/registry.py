"""Where queries over the driver's tables are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.functions.session import tune
from tributary.plans.rollup import plain_times

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, sf_dir: plain_times(f(tune(spark), sf_dir))
    return f
