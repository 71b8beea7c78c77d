"""What the text operators share: shared scratch tables, checked broadcasts, connected components."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.scratch import discard, release, scratch, shared_dir, stage
from tributary.functions.ship import ship

__all__ = ["checked", "components", "discard", "kept_rows", "lean", "looked_up", "quoted", "read", "release", "scratch", "shared_dir", "stage", "text_bytes", "text_hash", "to_python", "unused", "whole"]

#: The ASCII white space that separates words, as a Java and RE2 pattern.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a table may be broadcast; beyond that the join is shuffled.
BROADCAST_ROWS = 200_000
#: Bytes up to which it may be, whatever its rows.
BROADCAST_BYTES = 32 << 20
#: Keys that hold more than one in so many rows are looked up by broadcast, so there are fewer such keys than this.
HOT = 50_000

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def to_python(df: DataFrame, most: str = "4m") -> DataFrame:
    """df, ready for Python functions: the package is shipped, and a batch of rows holds so many bytes at most (or one row)."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    return df


def _give_back() -> None:
    """Hands memory that is free again back to the machine: workers live on between tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives free memory back about once a second and when it ends."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = time.monotonic()
        for b in run(batches):
            yield b
            if time.monotonic() - last > 1:
                _give_back()
                last = time.monotonic()
        _give_back()

    return own


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: strings, binaries and arrays by their contents, all else by a fixed width."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(quoted(name)), F.lit(0))
        elif kind.startswith("array"):
            size = size + F.coalesce(F.octet_length(F.to_json(quoted(name))), F.lit(0))
    return size


def checked(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it holds at most so many rows and bytes; a shuffled join otherwise. df should be cheap to count."""
    n, size = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= most else df


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], weight: str, how: str = "inner", small: bool = True) -> DataFrame:
    """rows joined (inner or left) with table, which has one row per key and says in `weight` how many of rows have that key.

    A small table is broadcast (not with small=False, for tables that only are small where the data are). Of a large one the keys of over 1 in HOT rows are: there are at most HOT such keys, however
    many rows there are, and no other key is crowded enough to hold up the task that the shuffle sends it to. rows should be
    staged, as they are read more than once.
    """
    if small and (sent := checked(table)) is not table:
        return rows.join(sent, on, how)
    limit = rows.count() // HOT
    hot = F.broadcast(table.where(F.col(weight) > limit))
    rest = rows.join(hot.select(*on), on, "left_anti").join(table.where(F.col(weight) <= limit), on, how)
    return rows.join(hot, on).unionByName(rest)


def quoted(name: str) -> Column:
    """The column of that very name, whatever dots are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that operators can carry rows beside columns of their own without a clash of names; `select("row.*")` takes it apart."""
    return F.struct(*[quoted(name) for name in docs.columns]).alias("row")


def unused(docs: DataFrame, name: str) -> str:
    """name, with underscores after it until docs has no such column in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def text_hash(column: str = "text") -> Column:
    """With doc_id, what tells a row from others wherever it is read: places in a scan may change from one read to the next."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def kept_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs that `decided` (doc_id, th = text_hash(), kept) keeps, each of repeated rows once; with all their columns.

    Only the keys that go are joined, so where these are few no text is shuffled. Null doc_ids and null texts are keys like
    any other, repeated rows (equal doc_id and text) are one, an empty table stays empty, and columns of docs may have any names.
    """
    keys = decided.groupBy(F.col("doc_id").alias("_doc_id"), F.col("th").alias("_key")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = stage(keys.where("n > 1 or not kept"), "dropped")
    rows = docs.select(whole(docs), F.col("doc_id").alias("_id"), text_hash().alias("_th"))
    on = F.col("_id").eqNullSafe(F.col("_doc_id")) & (F.col("_th") == F.col("_key"))
    out = rows.join(checked(keys), on, "left_anti")
    repeated = keys.where("kept")  # rows that are there several times, of which one stays
    if repeated.limit(1).count():
        out = out.unionByName(rows.join(checked(repeated), on, "left_semi").dropDuplicates(["_id", "_th"]))
    return out.select("row.*")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b: long): one row (node, component) per node that has an edge; component is the smallest node.

    Every round hooks each node to its smallest neighbour, halves the pointer paths and contracts the edges, so rounds are
    logarithmic in practice. Rounds end in shared tables; nothing but an edge count comes to the driver, and no node's
    neighbours are gathered: a hub with many edges is a min() that is combined before the shuffle.
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    pairs = stage(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels = None
    while pairs.limit(1).count():
        old = [pairs]
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("to"))
        hook = stage(hook, "hook")
        old.append(hook)
        for _ in range(2):
            up = hook.select(F.col("node").alias("to"), F.col("to").alias("top"))
            hook = hook.join(up, "to").select("node", F.col("top").alias("to"))
        hook = stage(hook, "jump")
        if labels is None:
            found = hook.select("node", F.col("to").alias("component"))
        else:
            old.append(labels)
            up = hook.select(F.col("node").alias("component"), F.col("to").alias("top"))
            found = labels.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        labels = stage(found, "labels")
        end = hook.select(F.col("node").alias("u"), F.col("to").alias("tu"))
        pairs = pairs.join(end, "u").join(end.select(F.col("u").alias("v"), F.col("tu").alias("tv")), "v")
        pairs = stage(pairs.where("tu <> tv").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct(), "edges")
        discard(*old, hook)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).where("false")
    return labels
