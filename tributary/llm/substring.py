"""Substring dedup with a log-structured fingerprint index.

A window is 50 consecutive words. Each window has an anchor, the least of the hashes of its 8-word runs; windows that are
equal have equal anchors. Successive windows of one anchor are a segment: about 22 windows, known by a 128-bit fingerprint of
all words that they cover. The index holds segments by anchor, as sorted immutable runs (bucketed files), each segment with
the first place that has it. A new batch, later in doc_id than those before it, is merge-joined with the runs: segments found there are duplicates
as a whole; it is kept as a new run, and runs are compacted when there are too many. That leaves anchors under which
several segments are known, as where a shared passage begins or ends: for these, and only these, the windows themselves
are fingerprinted from the text. No window that two documents share is missed, since its anchor, and so its segment, is
compared with all others of that anchor.

What is found is verified: the words that a document would lose are compared, byte by byte, with those of the place that
the index says they repeat. Should any differ, everything is done again with other hashes.

An index may be kept: it holds its runs and the texts that it was made of in a folder, so that a later table, whose
documents come after all before, is deduplicated against it without the earlier ones.

Documents that are equal as a whole are told by SHA-256 beforehand, so groups of copies take no part in the rest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import SPACE, checked, discard, lean, looked_up, scratch, stage, text_bytes, to_python

WINDOW = 50
RUN = 8
LAST = (1 << 63) - 1
#: Odd multipliers of the two rolling hashes, modulo 2**64.
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Windows of a claim that are verified in one piece, at most.
PIECE = 1_024
#: Bits of the hashes, by attempt; the attempt's number is the seed of the words' hashes.
ATTEMPTS = (64, 64, 64)

Batches = Iterator[pa.RecordBatch]


class Collision(Exception):
    """Different words have equal fingerprints."""


class Rolling:
    """Hashes of any run of words, by prefix sums of word hash times power."""

    _powers: list[list[np.ndarray]] = []

    @classmethod
    def powers(cls, n: int) -> list[list[np.ndarray]]:
        if not cls._powers or len(cls._powers[0][0]) < n:
            size = max(4096, 2 * n)
            cls._powers = [[np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (base, pow(base, -1, 1 << 64))] for base in BASE]
        return cls._powers

    def __init__(self, words: list[bytes], seed: int = 0, bits: int = 64) -> None:
        digest = xxhash.xxh3_128_digest
        joined = b"".join([digest(w, seed) for w in words]) if seed else b"".join(map(digest, words))
        h = np.frombuffer(joined, np.uint64).reshape(-1, 2)
        self.drop = np.uint64(64 - bits)
        self.powers_ = self.powers(len(words) + 1)
        self.sums = [np.r_[np.uint64(0), np.cumsum(h[:, k] * self.powers_[k][0][: len(words)], dtype=np.uint64)] for k in (0, 1)]

    def of(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        return ((self.sums[k][end] - self.sums[k][start]) * self.powers_[k][1][start]) >> self.drop


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def anchors(rolling: Rolling, n: int) -> np.ndarray:
    """The anchor of each of the n - 49 windows of n words."""
    at = np.arange(n - RUN + 1)
    h = _mixed(rolling.of(at, at + RUN, 0))
    need, have = WINDOW - RUN + 1, 1
    while have < need:  # the least of `have` neighbours, for growing `have`
        step = min(have, need - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def _indexed(seed: int, bits: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for b in batches:
            texts = b["text"].to_pylist()
            for lo in range(0, len(texts), 256):
                part = texts[lo : lo + 256]
                n_words, shas, offsets, columns = [], [], [0], [[], [], [], [], []]
                for t in part:
                    words = t.split()
                    n = len(words)
                    n_words.append(n)
                    shas.append(hashlib.sha256(b" ".join(words)).digest())
                    if n >= WINDOW:
                        rolling = Rolling(words, seed, bits)
                        a = anchors(rolling, n)
                        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                        end = np.r_[start[1:], len(a)]
                        for c, x in zip(columns, (a[start].view(np.int64), rolling.of(start, end + WINDOW - 1, 0).view(np.int64), rolling.of(start, end + WINDOW - 1, 1).view(np.int64), start.astype(np.int32), (end - start).astype(np.int32)), strict=True):
                            c.append(x)
                        offsets.append(offsets[-1] + len(start))
                    else:
                        offsets.append(offsets[-1])
                at = pa.array(offsets, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(c) if c else np.zeros(0, np.int32 if k > 2 else np.int64))) for k, c in enumerate(columns)]
                yield pa.record_batch(
                    [b["doc_id"].slice(lo, len(part)), b["id"].slice(lo, len(part)), b["th"].slice(lo, len(part)), pa.array(n_words, pa.int64()), pa.array(shas, pa.binary()), *lists],
                    ["doc_id", "id", "th", "n_words", "sha", "anchor", "seg", "chk", "pos", "len"],
                )

    return run


INDEXED = "doc_id long, id long, th long, n_words long, sha binary, anchor array<long>, seg array<long>, chk array<long>, pos array<int>, len array<int>"


def _windows(seed: int, bits: int) -> Callable[[Batches], Batches]:
    """Fingerprints of the windows that start in the given segments."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            ids, ths, texts = b["id"].to_pylist(), b["th"].to_pylist(), b["text"].to_pylist()
            for i, th, t, pos, size in zip(ids, ths, texts, b["pos"].to_pylist(), b["len"].to_pylist(), strict=True):
                rolling = Rolling(t.split(), seed, bits)
                starts = np.concatenate([np.arange(p, p + s) for p, s in zip(pos, size, strict=True)])
                for at in range(0, len(starts), 20_000):
                    s = starts[at : at + 20_000]
                    yield pa.record_batch({"h1": rolling.of(s, s + WINDOW, 0).view(np.int64), "h2": rolling.of(s, s + WINDOW, 1).view(np.int64), "id": np.full(len(s), i, np.int64), "th": np.full(len(s), th, np.int64), "pos": s.astype(np.int32)})

    return run


def claims(wid: np.ndarray, wth: np.ndarray, wpos: np.ndarray, pos: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Spans, each `size` windows from pos on that are said to repeat those from wpos on in document (wid, wth), as fewer ones (wid, wth, wpos, pos, size) that cover the same words.

    Spans of one document and offset are joined where they meet; then, of all that begin within what is covered, the one
    that reaches furthest is taken, so no word is in more than two. Those taken are cut where wpos is a multiple of PIECE.
    """
    off = wpos - pos
    order = np.lexsort((pos, off, wth, wid))
    wid, wth, off, lo, hi = wid[order], wth[order], off[order], pos[order], (pos + size)[order]
    # joined: a span begins anew where the document or the offset changes, or after a gap
    change = np.r_[True, (wid[1:] != wid[:-1]) | (wth[1:] != wth[:-1]) | (off[1:] != off[:-1])]
    group = np.cumsum(change) - 1
    far = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + group * far) - group * far  # the greatest end so far within the group
    new = change | np.r_[True, lo[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    wid, wth, off, lo, hi = wid[first], wth[first], off[first], lo[first], np.maximum.reduceat(hi, first)
    order = np.lexsort((-hi, lo))
    last = -1  # words before this are covered; a span covers those from its first window's first to its last window's last
    best = -1
    for k in [*order.tolist(), -1]:
        if best >= 0 and (k < 0 or lo[k] > last):
            low, high, to = int(lo[best]), int(hi[best]), int(off[best])
            last = high + WINDOW - 1
            while low < high:
                end = min(high, low + PIECE - (low + to) % PIECE)
                yield int(wid[best]), int(wth[best]), low + to, low, end - low
                low = end
            best = -1
        if k >= 0 and hi[k] + WINDOW - 1 > last and (best < 0 or hi[k] > hi[best]):
            if best < 0 and lo[k] > last:
                last = int(lo[k])  # nothing is covered from here on: any span that begins here may be next
            best = k


CUT = "id long, th long, n_removed long, kept_sha256 string, kept string, wid long, wth long, wpos int, len int, words binary"


def _cut(batches: Batches) -> Batches:
    """Per text a row with what is left of it without the words under the given spans, and (wid not null) the words that it loses, by claim."""
    kinds = {f.split(" ")[0]: {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[f.split(" ")[1]] for f in CUT.split(", ")}
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    for b in batches:
        lists = b["spans"]
        bounds, fields = lists.offsets.to_numpy(), {f: lists.values.field(f).to_numpy().astype(np.int64) for f in ("pos", "len", "wid", "wth", "wpos")}
        for k, (i, th, t) in enumerate(zip(b["id"].to_pylist(), b["th"].to_pylist(), b["text"].to_pylist(), strict=True)):
            words = t.split()
            pos, size, wid_, wth_, wpos_ = (x[bounds[k] : bounds[k + 1]] for x in fields.values())
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, pos, 1)
            np.add.at(cover, pos + size + WINDOW - 1, -1)
            out = np.cumsum(cover[:-1]) > 0
            left = b" ".join([w for w, o in zip(words, out.tolist(), strict=True) if not o])
            rows.append((i, th, int(out.sum()), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace"), None, None, None, None, None))
            held += len(left) + 200
            for wid, wth, wpos, at, n in claims(wid_, wth_, wpos_, pos, size):
                said = b" ".join(words[at : at + n + WINDOW - 1])
                rows.append((i, th, None, None, None, wid, wth, wpos, n, said))
                held += len(said) + 200
                if held > 1 << 20:
                    yield flush()
                    rows, held = [], 0
            if held > 1 << 20:
                yield flush()
                rows, held = [], 0
    if rows:
        yield flush()


def _quoted(batches: Batches) -> Batches:
    """The words at the places that are claimed to be repeated."""
    for b in batches:
        for wid, wth, t, places in zip(b["wid"].to_pylist(), b["wth"].to_pylist(), b["text"].to_pylist(), b["places"].to_pylist(), strict=True):
            words = t.split()
            for at in range(0, len(places), 256):
                some = places[at : at + 256]
                yield pa.record_batch({
                    "wid": pa.array([wid] * len(some), pa.int64()), "wth": pa.array([wth] * len(some), pa.int64()), "wpos": pa.array([p["wpos"] for p in some], pa.int32()), "len": pa.array([p["len"] for p in some], pa.int32()),
                    "words": pa.array([b" ".join(words[p["wpos"] : p["wpos"] + p["len"] + WINDOW - 1]) for p in some], pa.binary()),
                })


class FingerprintIndex:
    """Segments in sorted immutable runs, with the first place of each: (anchor, seg, chk, first (id, th, pos, len), last).

    A segment is there once per run; of several runs the earliest has the first place. Runs are bucketed and sorted by the whole key, so a batch and the runs are merged without a shuffle,
    and segments that share a common anchor are spread. All lies in one folder of the shared storage: runs, the hashes of
    whole texts, the texts themselves if the index is kept, and numbered states, the last of which tells what of it counts.
    A call that fails leaves the last state as it was.

    path: where the index is, or is to be, kept; without it, it goes when it is dropped.
    """

    KEY = ("anchor", "seg", "chk")
    FIELDS = "anchor long, seg long, chk long, first struct<id: long, th: long, pos: int, len: int>, last long"

    def __init__(self, spark: SparkSession, path: str | None = None, most_runs: int = 2, seed: int = 0, bits: int = 64) -> None:
        self.spark, self.most_runs, self.kept = spark, most_runs, path is not None
        self.path = (path or scratch(spark, "index")).rstrip("/")
        self.tables: list[str] = []
        states = self._states()
        self.number = int(states[-1][6:-5]) if states else 0
        empty = {"runs": [], "copies": [], "texts": [], "upto": None, "seed": seed, "bits": bits, "buckets": max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))}
        self.state = json.loads(self._file(states[-1])) if states else empty
        self.runs: list[str] = list(self.state["runs"])
        self.before = list(self.runs)  # what was there when the call began
        for run in self.runs:
            self.spark.sql(f"create table {run} ({self.FIELDS}) using parquet clustered by ({', '.join(self.KEY)}) sorted by ({', '.join(self.KEY)}) into {self.state['buckets']} buckets location '{self.path}/{run}'")
            self.tables.append(run)

    def _fs(self, name: str = ""):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _states(self) -> list[str]:
        fs, at = self._fs()
        return sorted(n for s in (fs.listStatus(at) if fs.exists(at) else []) if (n := s.getPath().getName()).startswith("state-") and n.endswith(".json"))

    def _file(self, name: str) -> str:
        return "\n".join(r["value"] for r in self.spark.read.text(f"{self.path}/{name}").collect())

    def _delete(self, name: str = "") -> None:
        fs, at = self._fs(name)
        fs.delete(at, True)

    def _write(self, df: DataFrame) -> str:
        """df comes from an aggregation by the key, which has dealt it out as the buckets are."""
        name = f"tributary_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.write.bucketBy(self.state["buckets"], *self.KEY).sortBy(*self.KEY).option("path", f"{self.path}/{name}").saveAsTable(name)
        return name

    def _forget(self, run: str) -> None:
        """Drops a run's table, and its files unless the stored state counts on them."""
        self.spark.sql(f"drop table if exists {run}")
        self.tables.remove(run)
        if run not in self.before:
            self._delete(run)

    def entries(self, runs: list[str]) -> DataFrame:
        out = self.spark.table(runs[0])
        for run in runs[1:]:
            out = out.unionByName(self.spark.table(run))
        return out

    def append(self, rows: DataFrame) -> DataFrame:
        """Adds a batch (anchor, seg, chk, id, th, pos, len), whose ids are over all before, as a run; returns its repeated segments (anchor, seg, chk, first)."""
        fresh = self._write(rows.groupBy(*self.KEY).agg(F.min(F.struct("id", "th", "pos", "len")).alias("first"), F.max("id").alias("last")))
        new = self.spark.table(fresh)
        repeated = new.where("first.id < last").drop("last")
        for run in self.runs:
            repeated = repeated.unionByName(new.select(*self.KEY).join(self.spark.table(run).drop("last").hint("merge"), list(self.KEY)))
        repeated = stage(repeated, "repeated")
        self.runs.append(fresh)
        if len(self.runs) - len(self.before) > self.most_runs:
            self.compact([r for r in self.runs if r not in self.before])
        return repeated

    def compact(self, runs: list[str]) -> None:
        """Merges some runs into one."""
        if len(runs) > 1:
            merged = self._write(self.entries(runs).groupBy(*self.KEY).agg(F.min("first").alias("first"), F.max("last").alias("last")))
            self.runs = [r for r in self.runs if r not in runs] + [merged]
            for run in runs:
                self._forget(run)

    def contested(self) -> DataFrame:
        """(anchor, seg, chk, first) of the anchors of this call's batches that have several segments, now or from before."""
        self.compact([r for r in self.runs if r not in self.before])
        run = self.entries([r for r in self.runs if r not in self.before]).drop("last")
        if self.before:
            old = self.entries(self.before).drop("last").join(checked(run.select("anchor").distinct()), "anchor", "left_semi")
            run = stage(run.unionByName(old).groupBy(*self.KEY).agg(F.min("first").alias("first")), "met")
        several = run.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
        return stage(run.join(several, "anchor", "left_semi"), "contested")

    def copies(self) -> DataFrame | None:
        """(sha, first) of the whole texts of earlier calls."""
        return self.spark.read.schema("sha binary, first long").parquet(*[f"{self.path}/{n}" for n in self.state["copies"]]) if self.state["copies"] else None

    def texts(self) -> DataFrame:
        """(id, th, text) of earlier calls, as far as they are in the runs."""
        return self.spark.read.schema("id long, th long, text binary").parquet(*[f"{self.path}/{n}" for n in self.state["texts"]])

    def commit(self, copies: DataFrame, texts: DataFrame, upto: int | None) -> None:
        """Makes this call's runs, whole texts' hashes and texts count from now on: by one new state, after all that it names is written."""
        if len(self.runs) > self.most_runs:
            self.compact(self.runs)
        names = {kind: f"{kind}-{uuid.uuid4().hex}" for kind in ("copies", "texts")}
        copies.write.parquet(f"{self.path}/{names['copies']}")
        texts.write.parquet(f"{self.path}/{names['texts']}")
        tops = [x for x in (upto, self.state["upto"]) if x is not None]
        state = self.state | {"runs": self.runs, "upto": max(tops) if tops else None} | {k: [*self.state[k], n] for k, n in names.items()}
        fs, at = self._fs(f"state-{self.number + 1:09d}.tmp")
        out = fs.create(at, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not fs.rename(at, self._fs(f"state-{self.number + 1:09d}.json")[1]):
            raise OSError(f"cannot write the index's state in {self.path}")
        old, self.before, self.state, self.number = self.before, list(self.runs), state, self.number + 1
        for run in old:
            if run not in self.runs:
                self._delete(run)

    def close(self) -> None:
        """Drops the tables, and the files of runs that no state counts on; those of an index that is not kept as a whole."""
        for run in list(self.tables):
            self._forget(run)
        if not self.kept:
            self._delete()


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, id, th, text): the place of a document among others, null last, and a hash that tells rows of one doc_id apart."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(LAST)).alias("id"), text_bytes().alias("text"))
    return rows.select("doc_id", "id", F.xxhash64("text").alias("th"), "text")


def _wanted(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(id, th, text) of the documents under keys (id, th). Few keys are sent to the scan, so that other texts are not shuffled."""
    return texts.join(checked(keys.select("id", "th")), ["id", "th"], "left_semi")


def substring_dedup(docs: DataFrame, batches: int = 3, with_text: bool = False, index: str | None = None, attempts: tuple[int, ...] = ATTEMPTS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256, and with_text also kept (words joined by one space).

    A word goes if a window that covers it also starts in a document with a smaller doc_id. A null text has no words; texts
    under 50 words lose none. A null doc_id is larger than all others; rows that share a doc_id take nothing from each other.
    An empty table gives an empty result. Other columns are ignored. Texts may be of any length.

    index: a folder (shared by all executors) with an index of earlier tables, or for a new one: documents of those count as
    earlier ones, and docs is added to it once the result is there. Their doc_ids must all be smaller (ValueError).
    attempts: bits of the hashes for each try; another follows only if words under equal hashes differ.
    """
    for seed, bits in enumerate(attempts):
        own = FingerprintIndex(docs.sparkSession, index, seed=seed, bits=bits)
        try:
            return _dedup(docs, own, batches, with_text)
        except Collision as e:
            if own.state["runs"] or seed + 1 == len(attempts):  # the stored hashes are what they are
                raise RuntimeError(f"{e}: build the index anew, with other seeds") from e
        finally:
            own.close()
    raise ValueError("no attempts")


def _dedup(docs: DataFrame, index: FingerprintIndex, batches: int, with_text: bool) -> DataFrame:
    seed, bits, upto = index.state["seed"], index.state["bits"], index.state["upto"]
    rows = stage(to_python(_rows(docs)).mapInArrow(lean(_indexed(seed, bits)), INDEXED), "segments")
    if index.kept:
        low, high = rows.where(F.col("id") < LAST).agg(F.min("id"), F.max("id")).first()
        if upto is not None and low is not None and low <= upto:
            raise ValueError(f"doc_id {low} is not after {upto}, the last one in the index")

    # copies of a whole document
    whole = rows.where(F.col("n_words") >= WINDOW).groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    known_copies = index.copies()
    if index.kept:
        whole = stage(whole, "whole")
    if known_copies is not None:
        seen = whole.select("sha").join(known_copies, "sha").groupBy("sha").agg(F.min("first").alias("seen"))
        whole = whole.join(seen, "sha", "left").withColumn("first", F.coalesce("seen", "first")).drop("seen")
    firsts = stage(whole.where("first < last").select("sha", "first", "n"), "copies")
    slim = looked_up(rows.select("doc_id", "id", "th", "n_words", "sha"), firsts, ["sha"], "n", "left")
    slim = slim.withColumn("copy", F.coalesce(F.col("first") < F.col("id"), F.lit(False)) & (F.col("n_words") >= WINDOW)).drop("first", "n")
    slim = stage(slim, "slim")
    active = looked_up(rows.where(F.col("n_words") >= WINDOW), firsts, ["sha"], "n", "left").where("first is null or first = id")
    active = stage(active.select("id", "th", F.explode(F.arrays_zip("anchor", "seg", "chk", "pos", "len")).alias("s")).select("id", "th", "s.*"), "active")
    discard(rows)

    cuts = active.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)] or [0.5], 1_000).alias("q")).first()["q"] or []
    bounds = [None, *sorted(set(cuts[: batches - 1])), None]
    found = []
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        batch = active.select(*index.KEY, "id", "th", "pos", "len")
        batch = batch if lo is None else batch.where(F.col("id") > lo)
        batch = batch if hi is None else batch.where(F.col("id") <= hi)
        found.append(index.append(batch))

    # segments that an earlier document has go as a whole; under anchors that have several segments, the windows of the
    # first document of each are looked at
    contested = index.contested()
    if not index.kept:
        index.close()
    known = contested.withColumn("contested", F.lit(True))
    for repeated in found:
        known = known.unionByName(repeated.withColumn("contested", F.lit(False)))
    known = known.groupBy(*index.KEY).agg(F.min("first").alias("first"), F.max("contested").alias("contested"))
    gone = (F.col("first.id") < F.col("id")).alias("gone")
    met = stage(active.join(known, list(index.KEY)).where("first.id < id or contested").select("id", "th", "pos", "len", gone, F.col("first.id").alias("wid"), F.col("first.th").alias("wth"), F.col("first.pos").alias("wpos")), "met")
    if not index.kept:
        discard(active)
    spans = met.where("gone").drop("gone")
    listed = lambda df: df.groupBy("id", "th").agg(F.collect_list("pos").alias("pos"), F.collect_list("len").alias("len"))
    parts = stage(listed(met.where("not gone")), "parts")
    texts = _wanted(_rows(docs).drop("doc_id"), parts).join(parts, ["id", "th"])
    if upto is not None:
        earlier = stage(listed(contested.where(F.col("first.id") <= upto).select("first.*")), "earlier")
        texts = texts.unionByName(_wanted(index.texts(), earlier).join(earlier, ["id", "th"]))
    windows = stage(to_python(texts).select("id", "th", "text", "pos", "len").mapInArrow(lean(_windows(seed, bits)), "h1 long, h2 long, id long, th long, pos int"), "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("id").alias("wid"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("wid < last")
    first = stage(first.select("h1", "h2", "wid", "n"), "first")
    same = stage(looked_up(windows, first, ["h1", "h2"], "n", small=False).drop("n"), "same")
    discard(windows, *found)
    places = same.where("id = wid").groupBy("h1", "h2").agg(F.min(F.struct(F.col("th").alias("wth"), F.col("pos").alias("wpos"))).alias("at"))
    places = stage(places.join(first.select("h1", "h2", "n"), ["h1", "h2"]), "places")
    single = looked_up(same, places, ["h1", "h2"], "n", small=False).where("id > wid" if upto is None else f"id > wid and id > {upto}")
    spans = spans.unionByName(single.select("id", "th", "pos", F.lit(1).alias("len"), "wid", "at.*"))
    spans = stage(spans.groupBy("id", "th").agg(F.collect_list(F.struct("pos", "len", "wid", "wth", "wpos")).alias("spans")), "spans")
    discard(contested, met, parts, first, same, places)

    marked = _wanted(_rows(docs).drop("doc_id"), spans).join(spans, ["id", "th"])
    done = stage(to_python(marked).select("id", "th", "text", "spans").mapInArrow(lean(_cut), CUT), "cut")
    _verify(docs, index, done.where("wid is not null"))
    cut = done.where("wid is null").select("id", "th", "n_removed", "kept_sha256", *["kept"] * with_text).dropDuplicates(["id", "th"])

    out = slim.join(cut, ["id", "th"], "left")
    removed = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = F.when(F.col("copy"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha"))))
    columns = ["doc_id", "n_words", removed.cast("long").alias("n_removed"), sha.alias("kept_sha256")]
    if with_text:
        plain = _rows(docs).select("id", "th", F.trim(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACE, " ")).alias("whole")).dropDuplicates(["id", "th"])
        out = out.join(plain, ["id", "th"])
        columns.append(F.when(F.col("copy"), "").otherwise(F.coalesce("kept", "whole")).alias("kept"))
    if index.kept:
        fresh = whole if known_copies is None else whole.join(known_copies.select("sha"), "sha", "left_anti")
        index.commit(fresh.select("sha", "first"), _wanted(_rows(docs).drop("doc_id"), active.select("id", "th").distinct()).dropDuplicates(["id", "th"]), high)
    discard(active)
    return out.select(*columns)


def _verify(docs: DataFrame, index: FingerprintIndex, said: DataFrame) -> None:
    """Compares the words of all claims (wid, wth, wpos, len, words) with those at the places that they name.

    Claims on one place are combined before the shuffle, as the least and the greatest of their words: all are equal to what
    is there if these two are. Raises Collision otherwise.
    """
    key = ["wid", "wth", "wpos", "len"]
    each = stage(said.groupBy(*key).agg(F.min("words").alias("least"), F.max("words").alias("most")), "claims")
    asked = stage(each.groupBy("wid", "wth").agg(F.collect_list(F.struct("wpos", "len")).alias("places")), "places")
    keys = asked.select(F.col("wid").alias("id"), F.col("wth").alias("th"))
    texts = _wanted(_rows(docs).drop("doc_id"), keys)
    if index.state["upto"] is not None:
        texts = texts.unionByName(_wanted(index.texts(), keys))
    texts = texts.withColumnsRenamed({"id": "wid", "th": "wth"}).join(asked, ["wid", "wth"])
    there = to_python(texts).select("wid", "wth", "text", "places").mapInArrow(lean(_quoted), "wid long, wth long, wpos int, len int, words binary")
    differ = each.join(there, key, "left").where("words is null or least <> words or most <> words")
    if differ.limit(1).count():
        raise Collision("different words have equal fingerprints")
    discard(each, asked)
