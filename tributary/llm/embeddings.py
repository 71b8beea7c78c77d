"""Embedding near-dedup with randomised-rotation binary codes and stored correction factors.

A unit vector o is rotated by a fixed random orthogonal matrix R and stored as the signs of its coordinates and the
factor a = <o', o>, where o' is the unit vector with those signs. For another rotated unit vector q and b = <o', q>, b / a
is an unbiased estimate of the cosine <o, q> over the choice of R: it is off by sqrt(1 - a^2) / a times the cosine of q with
a random direction in d - 1 dimensions, which is over z / sqrt(d - 1) with a probability of about exp(-z^2 / 2). That gives
a confidence bound; besides, o and q can be no nearer to each other than their angles with o' allow, so the cosine is at
most a b + sqrt((1 - a^2)(1 - b^2)), for certain. A pair is open, to be recomputed in double precision, if the lower of the
two bounds reaches the threshold; all others are done with. With z = 8 the first fails less than once in 1e13 pairs. Both
bounds grow with b, so for each stored code there is one value that b has to reach.

Codes (a bit per dimension), factors and queries (the rotated vectors in a byte per dimension, with the length of what the
bytes lose, which is added to b) are made once and stored. Vectors of a label are dealt into blocks of bounded size, and
each two blocks meet once:
  1. one's codes and the other's queries alone tell which vectors have an open pair there;
  2. for these, and only these, the vectors themselves are sent there, and open pairs are recomputed.
Equal vectors are one node with a weight. A task returns a count per vector and which vectors it found connected, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import checked, components, discard, lean, looked_up, stage, to_python

THRESHOLD = 0.98
#: Standard deviations of the confidence bound.
Z = 8.0
#: Vectors of a block at most, and bytes that they take in double precision.
BLOCK = 16_384
BLOCK_BYTES = 64 << 20
#: Vectors of a block that are always allowed.
SHARE = 256


@cache
def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; whatever their magnitude, since each is divided by its largest component first."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, correction factors, and the rotated vectors, of unit vectors."""
    x = x @ turn.T
    return np.packbits(x >= 0, axis=1), np.abs(x).sum(1) / np.sqrt(x.shape[1]), x


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors in a byte per dimension, what a step of it stands for, and the length of what is lost."""
    step = np.abs(x).max(1) / 127
    q = np.rint(x / step[:, None]).astype(np.int8)
    return q, step, np.linalg.norm(x - q * step[:, None], axis=1)


def products(codes: np.ndarray, queries: np.ndarray, step: np.ndarray) -> np.ndarray:
    """b of all (code, query) pairs."""
    d = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    return signs @ (queries * (step / np.sqrt(d))[:, None]).astype(np.float32).T


def cutoff(factor: np.ndarray, d: int, threshold: float, z: float = Z) -> np.ndarray:
    """What b has to reach for the lower of the two bounds to reach the threshold."""
    a = np.clip(factor, 1e-9, 1)
    certain = np.cos(np.minimum(np.arccos(a) + np.arccos(threshold), np.pi))
    likely = a * threshold - np.sqrt(1 - a * a) * z / np.sqrt(max(d - 1, 1))
    return np.maximum(certain, likely)


def open_pairs(codes: np.ndarray, factor: np.ndarray, queries: np.ndarray, step: np.ndarray, lost: np.ndarray, threshold: float, same: bool, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions of codes, positions of queries) of the open pairs, some at a time; of one block with itself (same) each pair once."""
    least = cutoff(factor, queries.shape[1], threshold) - 1e-4  # what single precision may lose
    for at in range(0, len(codes), rows):
        low = at + 1 if same else 0
        may = products(codes[at : at + rows], queries[low:], step[low:]) + lost[low:].astype(np.float32) >= least[at : at + rows, None]
        if same:
            may &= np.arange(low, len(queries))[None, :] > np.arange(at, min(at + rows, len(codes)))[:, None]
        i, j = np.nonzero(may)
        yield i + at, j + low


class Classes:
    """Which of n things are connected: each knows the least that it is connected with."""

    def __init__(self, n: int) -> None:
        self.least = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        least = self.least
        while True:
            x, y = least[a], least[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
            while (up := least[least]).tolist() != least.tolist():
                least[:] = up


def _bytes(table: pa.Table, name: str, kind: type) -> np.ndarray:
    """A binary column of equally long values as the rows of a matrix."""
    values = table[name].to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


CODED = [
    T.StructField("code", T.BinaryType()), T.StructField("factor", T.DoubleType()), T.StructField("query", T.BinaryType()), T.StructField("step", T.DoubleType()), T.StructField("lost", T.DoubleType()), T.StructField("vector", T.BinaryType()),
]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, copies, label, length and embedding -> the first four and what is stored of the vector."""
    for b in batches:
        lengths = b["length"].to_numpy()
        for d in np.unique(lengths).tolist():
            own = pa.array(lengths == d)
            part = b.filter(own)
            x = units(part["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d))
            code, factor, turned = encode(x, rotation(d))
            query, step, lost = quantised(turned)
            raw = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.record_batch([*(part[n] for n in ("node", "copies", "label", "length")), raw(code), pa.array(factor), raw(query), pa.array(step), pa.array(lost), raw(x)], ["node", "copies", "label", "length", *(f.name for f in CODED)])


PAIR = ("label", "length", "i", "j")


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The rows that give codes and those that give queries; whether they are one block."""
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    own = table["own"].to_numpy()
    return (table, table, True) if i == j else (table.filter(pa.array(own == i)), table.filter(pa.array(own == j)), False)


def _opened(left: pa.Table, right: pa.Table, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if len(left) and len(right):
        yield from open_pairs(_bytes(left, "code", np.uint8), _numbers(left, "factor"), _bytes(right, "query", np.int8), _numbers(right, "step"), _numbers(right, "lost"), threshold, same)


def involved(table: pa.Table, threshold: float) -> pa.Table:
    """The nodes of two blocks that have an open pair there."""
    left, right, same = _sides(table)
    hit, met = np.zeros(len(left), bool), np.zeros(len(right), bool)
    for i, j in _opened(left, right, threshold, same):
        hit[i] = True
        met[j] = True
    nodes = _numbers(left, "node")[hit | met] if same else np.concatenate([_numbers(left, "node")[hit], _numbers(right, "node")[met]])
    out = {n: pa.array([table[n][0].as_py()] * len(nodes), table.schema.field(n).type) for n in PAIR}
    return pa.table(out | {"node": pa.array(nodes, pa.int64())})


def linked(table: pa.Table, threshold: float) -> pa.Table:
    """Links of two blocks' nodes: rows (a, b, n): n links counted for a, or a connected with b, with n = 0."""
    left, right, same = _sides(table)
    x = _bytes(left, "vector", np.float64)
    y = x if same else _bytes(right, "vector", np.float64)
    xid, yid, xw, yw = _numbers(left, "node"), _numbers(right, "node"), _numbers(left, "copies"), _numbers(right, "copies")
    nx, ny, base = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64), 0 if same else len(left)
    classes = Classes(len(left) + (0 if same else len(right)))
    for i, j in _opened(left, right, threshold, same):
        some = max(1, (16 << 20) // (8 * x.shape[1]))
        for at in range(0, len(i), some):
            pi, pj = i[at : at + some], j[at : at + some]
            ok = np.einsum("ij,ij->i", x[pi], y[pj]) >= threshold
            pi, pj = pi[ok], pj[ok]
            np.add.at(nx, pi, yw[pj])
            np.add.at(ny, pj, xw[pi])
            classes.join(pi, pj + base)
    ids, n = (xid, nx + ny) if same else (np.concatenate([xid, yid]), np.concatenate([nx, ny]))
    hit, joined = n > 0, classes.least != np.arange(len(ids))
    a, b = np.concatenate([ids[hit], ids[joined]]), np.concatenate([ids[hit], ids[classes.least[joined]]])
    return pa.table({"a": a, "b": b, "n": np.concatenate([n[hit], np.zeros(int(joined.sum()), np.int64)])})


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of equal, non-null labels and of equal lengths are compared. A vector that is null, empty or zero, that
    holds a null, NaN or infinite component, or that has a null label links with nothing. Repeated rows are vectors of
    their own and link with each other. An empty table gives an empty result. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.expr("label is not null and vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("length", F.size("embedding"))
    rows = stage(rows.withColumn("v", F.when(F.col("fine"), F.xxhash64("embedding"))), "vectors")
    nodes = rows.where("fine").groupBy("label", "length", "v", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    coded = T.StructType([nodes.schema[n] for n in ("node", "copies", "label", "length")] + CODED)
    codes = stage(to_python(nodes.select("node", "copies", "label", "length", "embedding")).mapInArrow(lean(_coded), coded), "codes")

    # block pairs: codes of the one and queries of the other
    # no more vectors in a block than a task's share of all, so that a label that many have is not one task's
    share = max(SHARE, nodes.count() // max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    most = F.greatest(F.lit(1), F.least(F.lit(min(block, share)), F.floor(F.lit(BLOCK_BYTES) / (F.col("length") * 8))))
    blocks = nodes.groupBy("label", "length").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"), F.count(F.lit(1)).alias("nodes"))
    dealt = looked_up(codes, blocks, ["label", "length"], "nodes").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    gives = lambda name, side: F.when(F.col("own") == F.col(side), F.col(name)).alias(name)
    first = to_python(dealt.select(*PAIR, "own", "node", gives("code", "i"), gives("factor", "i"), gives("query", "j"), gives("step", "j"), gives("lost", "j")))
    kept = T.StructType([first.schema[n] for n in (*PAIR, "node")])
    opened = stage(first.groupBy(*PAIR).applyInArrow(lambda t: involved(t, threshold), kept), "involved")

    # what is open, with the vectors themselves
    own = F.when(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int") == F.col("i"), F.col("i")).otherwise(F.col("j"))
    second = opened.join(codes.drop("label", "length"), "node").join(checked(blocks.drop("nodes")), ["label", "length"]).withColumn("own", own)
    found = stage(to_python(second.drop("blocks")).groupBy(*PAIR).applyInArrow(lambda t: linked(t, threshold), "a long, b long, n long"), "found")
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    classes = components(found.where("n = 0").select("a", "b"))
    keys = ["label", "length", "v"]
    if nodes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        keys.append("embedding")  # different vectors of one hash
    slim = nodes.select(*keys, "node", "vec_id", "copies").join(counts, "node", "left").join(classes, "node", "left")
    slim = stage(slim.select(*keys, "vec_id", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component")), "classes")
    tops = stage(slim.groupBy("component").agg(F.min("vec_id").alias("component_id"), F.count(F.lit(1)).alias("members")), "tops")
    done = looked_up(slim.select(*keys, "copies", "n", "component"), tops, ["component"], "members")
    done = stage(done.select(*keys, "copies", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"), "done")
    out = looked_up(rows.select("vec_id", *keys), done, keys, "copies", "left")
    discard(codes, opened, found, slim)
    top = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), top.alias("component_id"), F.coalesce(F.col("vec_id") == top, F.lit(True)).alias("kept"))
