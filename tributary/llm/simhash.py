"""SimHash near-dedup by Golay-code fuzzy hashing.

The binary Golay code of length 23 is perfect: every 23-bit word is within 3 bits of exactly one codeword, its home. Words
x and y at 1 bit or less share y's home among the codewords within 4 bits of x; at 2 bits, both are within 4 bits of the
home of a word between them. A word has one codeword within 4 bits, or six where its home is 3 bits away.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. If two fingerprints differ in 4 bits or fewer, some two
segments differ in 2 bits or fewer together (the third has the most). So each fingerprint gets, for every two segments,
  - keys of the pair of homes (probe side) and of all pairs of nearby codewords (index side), for 1 + 1, 1 + 0 and 0 + 0 bits,
  - keys of one segment as it is and of a codeword near the other (both sides), for 0 + 2 bits,
each of about 24 bits or more. Fingerprints that meet under a key are compared by popcount. Equal fingerprints are one
node, whatever their number. Fingerprints that meet under a key are compared in blocks; only a spanning forest of what a
task has found goes on, never all pairs. A key with more than `block` fingerprints is dealt over a grid of tasks, so that
no task gets more of it than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import checked, components, discard, lean, looked_up, stage, text_bytes, text_hash, to_python

SEED = 42
MAX_BITS = 4
#: Generator polynomial of the code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    total, at = np.zeros(64, np.int64), 0
    last = ends[width - 1 :].tolist()
    while at < n:  # a bounded piece at a time, however long the text is
        piece = range(at, min(n, at + 50_000))
        h = np.fromiter([digest(joined[starts[i] : last[i]], SEED) for i in piece], np.uint64, len(piece))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        at += len(piece)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words (as polynomials) by the generator."""
    x = x.astype(np.int64)
    for bit in range(22, 10, -1):
        x = np.where((x >> bit) & 1, x ^ (GENERATOR << (bit - 11)), x)
    return x


def _patterns() -> np.ndarray:
    """By syndrome: the error patterns of 4 bits or fewer, lightest first; a row repeats its first where there is but one."""
    table = np.zeros((2048, 6), np.int64)
    seen = np.zeros(2048, np.int64)
    unit = 1 << np.arange(23, dtype=np.int64)
    i, j, k, m = np.meshgrid(*[np.arange(23)] * 4, indexing="ij")
    four = (unit[i] | unit[j] | unit[k] | unit[m])[(i < j) & (j < k) & (k < m)]
    three = np.unique((unit[i] | unit[j] | unit[k]))
    low = three[np.bitwise_count(three) <= 3]
    for e in [0, *low[np.argsort(np.bitwise_count(low), kind="stable")].tolist(), *four.tolist()]:
        s = _SYNDROME_OF(e)
        if seen[s] == 0 or (seen[s] < 6 and e not in table[s, : seen[s]]):
            table[s, seen[s]] = e
            seen[s] += 1
    for s in range(2048):
        table[s, seen[s] :] = table[s, 0]
    return table


def _SYNDROME_OF(e: int) -> int:
    for bit in range(22, 10, -1):
        if e >> bit & 1:
            e ^= GENERATOR << (bit - 11)
    return e


_TABLE: list[np.ndarray] = []


def codewords(x: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within 4 bits of each 23-bit word, home first: shape (n, 6), repeating the home where it is the only one."""
    if not _TABLE:
        _TABLE.append(_patterns())
    near = x.astype(np.int64)[:, None] ^ _TABLE[0][_syndrome(x)]
    return near >> 11  # a codeword is known by its 12 upper bits


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, side, position in fps) of all keys of fingerprints (uint64). side: 0 probe, 1 index, 2 both."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    near = [codewords(p) for p in parts]
    several = [n[:, 1] != n[:, 0] for n in near]
    rows = np.arange(len(fps))
    out: list[tuple[np.ndarray, int, np.ndarray]] = []
    kind = 0
    for i, j in ((0, 1), (0, 2), (1, 2)):
        out.append(((kind << 48) | (near[i][:, 0] << 12) | near[j][:, 0], 0, rows))
        for a in range(6):
            for b in range(6):
                own = (several[i] | (a == 0)) & (several[j] | (b == 0))
                out.append(((kind << 48) | (near[i][own, a] << 12) | near[j][own, b], 1, rows[own]))
        kind += 1
        for exact, fuzzy in ((i, j), (j, i)):
            for b in range(6):
                own = several[fuzzy] | (b == 0)
                out.append(((kind << 48) | (parts[exact][own] << 12) | near[fuzzy][own, b], 2, rows[own]))
            kind += 1
    return np.concatenate([k for k, _, _ in out]), np.concatenate([np.full(len(k), s, np.int8) for k, s, _ in out]), np.concatenate([r for _, _, r in out])


class Forest:
    """Union-find over the fingerprints of one task; keeps the links that join two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def add(self, a: int, b: int) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t or b"") for t in b["text"].to_pylist()], np.uint64).view(np.int64)
        yield pa.record_batch({"uid": b["uid"], "doc_id": b["doc_id"], "th": b["th"], "fp": fps})


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b["fp"].to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 2_000):
            k, side, row = keys(fps[at : at + 2_000].view(np.uint64))
            yield pa.record_batch({"key": k, "side": side, "fp": fps[at : at + 2_000][row]})


def _met(key: np.ndarray, side: np.ndarray, fp: np.ndarray, forest: Forest, chunk: int = 500_000) -> None:
    """Compares what meets under a key (sorted): probes with the index side, or all with all where a key has one side only."""
    fp = fp.view(np.uint64)
    new = np.r_[True, key[1:] != key[:-1]]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    first = starts + np.add.reduceat((side == 0).astype(np.int64), starts)  # probes come first
    p = np.flatnonzero(side != 1)
    lo_ = np.where(side[p] == 2, p + 1, first[group[p]])
    hi_ = np.r_[starts[1:], len(key)][group[p]]
    p, lo_, hi_ = (x[lo_ < hi_] for x in (p, lo_, hi_))
    many = hi_ - lo_
    total = np.cumsum(many)
    at = 0
    while at < len(p):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + chunk, "right")))
        n = many[at:to]
        left = np.repeat(p[at:to], n)
        right = np.repeat(lo_[at:to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a, b = fp[left], fp[right]
        ok = (np.bitwise_count(a ^ b) <= MAX_BITS) & (a != b)
        if ok.any():
            found = np.unique(np.stack([np.minimum(a[ok], b[ok]).view(np.int64), np.maximum(a[ok], b[ok]).view(np.int64)], 1), axis=0)
            for x, y in found.tolist():
                forest.add(x, y)
        at = to


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, part, side). A group is whole within a task; groups are taken some at a time."""
    forest = Forest()
    held: list[tuple[np.ndarray, ...]] = []

    def flush(rows: tuple[np.ndarray, ...]) -> None:
        if len(rows[0]):
            _met(*rows, forest)

    for b in batches:
        group = b["group"].to_numpy(zero_copy_only=False)
        rows = (group, b["side"].to_numpy(zero_copy_only=False), b["fp"].to_numpy(zero_copy_only=False))
        if not len(group):
            continue
        cut = int(np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[-1])
        if cut == 0 and held and held[-1][0][-1] == group[0]:
            held.append(rows)
            continue
        held.append(tuple(x[:cut] for x in rows))
        flush(tuple(map(np.concatenate, zip(*held, strict=True))))
        held = [tuple(x[cut:] for x in rows)]
    if held:
        flush(tuple(map(np.concatenate, zip(*held, strict=True))))
    links = np.array(forest.links, np.int64).reshape(-1, 2)
    for at in range(0, len(links), 50_000):
        yield pa.record_batch({"a": links[at : at + 50_000, 0], "b": links[at : at + 50_000, 1]})


def links(fps: DataFrame, block: int = 20_000) -> DataFrame:
    """A spanning forest (a, b) per task of the links between the distinct fingerprints of fps (column fp: long), staged."""
    spark = fps.sparkSession
    all_keys = keyed = stage(to_python(fps).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))).select("fp").mapInArrow(lean(_keyed), "key long, side byte, fp long"), "keys")
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    crowded = stage(crowded.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "crowded")
    if crowded.limit(1).count():
        # a grid of parts: a probe has its own row of it, an index row its own column
        wide = keyed.join(checked(crowded), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        alone = wide.where("parts = 1").withColumn("part", F.lit(0))
        probes = wide.where("parts > 1 and side <> 1").withColumn("_i", every).withColumn("part", own * F.col("parts") + F.col("_i")).withColumn("side", F.lit(0).cast("byte")).drop("_i")
        second = wide.where("parts > 1 and side <> 0").withColumn("_i", every).withColumn("part", F.col("_i") * F.col("parts") + own).withColumn("side", F.lit(1).cast("byte")).drop("_i")
        keyed = alone.unionByName(probes).unionByName(second).select(F.xxhash64("key", "part").alias("group"), "side", "fp")
    else:
        keyed = keyed.select(F.col("key").alias("group"), "side", "fp")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = stage(keyed.repartition(parts, "group").sortWithinPartitions("group", "side").mapInArrow(lean(_linked), "a long, b long"), "links")
    discard(all_keys, crowded)
    return found


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of docs: uid, doc_id, th, fingerprint (16 hex digits), component_id (smallest doc_id reachable), kept.

    Null and empty texts have fingerprint 0 and link like any other. Of each component one row is kept: the one with the
    smallest doc_id (null last; of repeated rows one). A component whose doc_ids are all null has a null component_id.
    Texts of any length are read whole, some shingles at a time. An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), text_bytes().alias("text"))
    rows = stage(to_python(rows).mapInArrow(lean(_fingerprints), "uid long, doc_id long, th long, fp long"), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    nodes = stage(rows.groupBy("fp").agg(F.min(first).alias("head"), F.count(F.lit(1)).alias("n")), "nodes")
    forest = links(nodes)
    found = components(forest)
    nodes = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "head", "n", F.coalesce("component", "fp").alias("component"))
    nodes = stage(nodes, "classes")
    heads = stage(nodes.groupBy("component").agg(F.min("head").alias("top"), F.count(F.lit(1)).alias("nodes")), "tops")
    nodes = looked_up(nodes, heads, ["component"], "nodes").select("fp", "n", F.col("top.doc_id").alias("component_id"), F.col("top.uid").alias("_top"))
    out = looked_up(rows, stage(nodes, "heads"), ["fp"], "n")
    return out.select("uid", "doc_id", "th", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", (F.col("uid") == F.col("_top")).alias("kept"))
