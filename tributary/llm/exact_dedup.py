"""Exact dedup over an extendible-hash index in shared files (DataFrame operations only).

A text's key is the 64-bit hash of its normalised form. Rows are combined per key before any shuffle, so a text that a
third of all rows repeat is one index entry. The directory starts with one slot and doubles while a bucket holds more
than `capacity` entries; a bucket that is still overfull at `max_depth` bits keeps an overflow chain. Entries are
written as one file set per bucket, in key order, by tasks that each own a range of keys. An entry holds the row that
stays; rows of keys that occur once are answered from the index itself, all others look their key up in the bucket that
the directory names for it. Every key that holds more than
one row has its rows' bytes compared (as the smallest and largest text per key, combined before the shuffle); a key
whose rows differ is a chain of collisions, which is told apart by the whole text. So results are exact even where hashes collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import SPACE, checked, discard, looked_up, stage, text_hash


def normalised(column: str = "text") -> Column:
    """Each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), SPACE, " ")


def grow_directory(counts: dict[int, int], capacity: int, max_depth: int) -> tuple[int, list[tuple[int, int]]]:
    """Splits overfull buckets, doubling the directory where needed: the global depth and (prefix, local depth) by key order.

    counts: entries per `max_depth`-bit key prefix, 2**max_depth numbers at most whatever the size of the data.
    """
    below = [[0] * (1 << d) for d in range(max_depth + 1)]
    for prefix, n in counts.items():
        below[max_depth][prefix] = n
    for d in range(max_depth, 0, -1):
        for prefix in range(1 << (d - 1)):
            below[d - 1][prefix] = below[d][2 * prefix] + below[d][2 * prefix + 1]
    depth, buckets, todo = 0, [], [(0, 0)]
    while todo:
        prefix, d = todo.pop()
        if below[d][prefix] > capacity and d < max_depth:
            depth = max(depth, d + 1)
            todo += [(2 * prefix + 1, d + 1), (2 * prefix, d + 1)]
        else:
            buckets.append((prefix, d))
    return depth, buckets


def directory_table(spark: SparkSession, depth: int, buckets: list[tuple[int, int]]) -> DataFrame:
    """slot -> bucket for all 2**depth slots; a bucket of local depth d fills 2**(depth - d) slots."""
    slots = [(slot, b) for b, (prefix, d) in enumerate(buckets) for slot in range(prefix << (depth - d), (prefix + 1) << (depth - d))]
    return spark.createDataFrame(slots, "slot long, bucket int")


def exact_dedup(docs: DataFrame, capacity: int = 100_000, max_depth: int = 12, key_bits: int = 64) -> DataFrame:
    """One row per row of docs: uid, doc_id, th, keep_id, group_size, kept, text_sha256. uid tells rows of this result apart, no more.

    Of rows whose normalised texts are equal the one with the smallest doc_id stays (null last; of repeated rows with
    that doc_id exactly one stays). Null and empty texts are equal to each other. An empty table gives an empty result.
    Other columns are ignored. key_bits under 64 provokes collisions, for tests.
    """
    spark = docs.sparkSession
    norm = docs.select("doc_id", text_hash().alias("th"), normalised().alias("norm"))
    key = F.xxhash64("norm") if key_bits == 64 else F.shiftrightunsigned(F.xxhash64("norm"), 64 - key_bits)
    rows = stage(norm.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "th", key.alias("key"), F.sha2("norm", 256).alias("text_sha256")), "rows")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "th", "text_sha256")).alias("head")
    entries = stage(rows.groupBy("key").agg(first, F.count(F.lit(1)).alias("group_size")), "entries")
    prefix = lambda bits: F.shiftrightunsigned("key", key_bits - bits) if bits else F.lit(0).cast("long")
    max_depth = min(max_depth, key_bits)
    counts = {r["slot"]: r["n"] for r in entries.groupBy(prefix(max_depth).alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    depth, buckets = grow_directory(counts, capacity, max_depth)
    directory = F.broadcast(directory_table(spark, depth, buckets))  # 2**max_depth rows at most

    def routed(df: DataFrame) -> DataFrame:
        """df with the bucket that the directory has for its keys."""
        return df.withColumn("slot", prefix(depth)).join(directory, "slot").drop("slot")

    owners = max(1, min(len(buckets), 4096))
    index = stage(routed(entries).repartitionByRange(owners, "bucket", "key").sortWithinPartitions("bucket", "key"), "index", by="bucket")
    discard(entries)

    repeated = checked(index.where("group_size > 1").select("key"))
    texts = norm.select(key.alias("key"), "norm").join(repeated, "key")
    clash = stage(texts.groupBy("key").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).where("low <> high").select("key"), "clash")

    out = ["uid", "doc_id", "th", "keep_id", "group_size", "kept", "text_sha256"]
    single = index.where("group_size = 1").select("head.uid", "head.doc_id", "head.th", F.col("head.doc_id").alias("keep_id"), "group_size", F.lit(True).alias("kept"), "head.text_sha256")
    heads = index.where("group_size > 1").select("bucket", "key", F.col("head.doc_id").alias("keep_id"), F.col("head.uid").alias("keep_uid"), "group_size")
    own = (F.col("uid") == F.col("keep_uid")).alias("kept")
    found = lambda asked: looked_up(routed(asked), heads, ["bucket", "key"], "group_size").select(*[own if c == "kept" else c for c in out])
    if not clash.limit(1).count():
        return single.unionByName(found(rows))

    # chained collisions: a few keys, whose rows are told apart by their bytes
    chained = norm.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "th", key.alias("key"), F.sha2("norm", 256).alias("text_sha256"), "norm").join(checked(clash), "key")
    chained = stage(chained, "chained")
    chain = chained.groupBy("key", "norm").agg(first, F.count(F.lit(1)).alias("group_size"))
    chain = chain.select("key", "norm", F.col("head.doc_id").alias("keep_id"), F.col("head.uid").alias("keep_uid"), "group_size")
    alone = found(rows.join(checked(clash), "key", "left_anti"))
    return single.unionByName(alone).unionByName(chained.join(chain, ["key", "norm"]).select(*[own if c == "kept" else c for c in out]))
