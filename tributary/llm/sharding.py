"""Sharding by a Feistel permutation with cycle walking over global row numbers (DataFrame operations only).

Rows are numbered 0..n-1 in the order of doc_id: a range partitioning, positions within partitions, and the counts of the
partitions before (one number per partition). The permutation is an alternating Feistel network over the mixed-radix domain
Z_a x Z_b, with a = ceil(sqrt(n)) and b = ceil(n / a): fewer than a of its a*b points lie outside 0..n-1, so walking the
cycle until it comes back inside ends after fewer than a steps, and only fewer than a rows need a step at all.
Row r goes to shard P(r) mod S at slot P(r) div S: counts differ by one at most and slots have no gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import checked, stage

ROUNDS = 6


def domain(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(n - 1) + 1 if n > 1 else 1)
    return a, max(1, -(-n // a))


def _round_key(seed: int, i: int) -> int:
    return seed * 1_000_003 + i


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network; x in 0..a*b-1. Even rounds change the left digit, odd rounds the right one."""
    left, right = F.call_function("div", x, F.lit(b)), F.pmod(x, F.lit(b))
    for i in range(ROUNDS):
        if i % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(_round_key(seed, i))), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(_round_key(seed, i))), F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def permuted(row: Column, n: int, seed: int) -> Column:
    """The row's place in the shuffle of 0..n-1."""
    a, b = domain(n)
    once = feistel(row, a, b, seed)
    outside = a * b - n
    if not outside:
        return once
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(outside)), once, lambda at, _: F.when(at < F.lit(n), at).otherwise(feistel(at, a, b, seed)))
    return F.when(once < F.lit(n), once).otherwise(walk)


def numbered(rows: DataFrame, order: list[str], name: str = "row") -> tuple[DataFrame, int]:
    """Adds global row numbers 0..n-1 in the given order; returns the rows and n. The numbers do not depend on how many partitions there are."""
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("_place", F.monotonically_increasing_id())
    placed = stage(placed, "placed")  # numbers come from what is written, so a task that is run again cannot move them
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"), "_n")
    n = sizes.agg(F.sum("_n")).first()[0] or 0
    row = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(checked(starts), "_part").withColumn(name, row).drop("_part", "_place", "_before", "_n"), n


def shard(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, row (the global number).

    Row counts of shards differ by one at most (law `rows`). Rows are numbered by doc_id (null last), repeated doc_ids by
    size and checksum; rows equal in all of these are interchangeable. A null text has no bytes. Under `shards` rows, the
    last shards are empty; an empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, n = numbered(rows.withColumn("_null", F.col("doc_id").isNull()), ["_null", "doc_id", "size", "text_crc32"])
    at = permuted(F.col("row"), max(n, 1), seed)
    rows = rows.drop("_null").withColumn("_at", at)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("_at", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("_at"), F.lit(shards)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )
