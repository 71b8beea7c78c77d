"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is bound by multiplying its letters' vectors, each permuted (rolled)
by its place; a text is the bundle, the sum, of its n-grams' vectors; a language is the bundle of its training texts, each
of length 1. A text goes to the language whose prototype has the largest cosine with it, which is the score.
N-grams run over lower-cased letters; whatever lies between words is one letter of its own. Since a bundle is a sum, an
n-gram's vector is made once per run of texts, times its count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import checked, lean, text_bytes, to_python, whole

DIMENSION = 512
GRAM = 3
#: Labelled rows that prototypes are learnt from, at most in expectation, in fair shares for the languages; a hash of doc_id and text picks them.
SAMPLE_ROWS = 12_000
#: A language's share at least, in expectation, if it has as many rows.
LEAST_ROWS = 64
#: Languages that are learnt at most, those with the most labelled rows: what comes to the driver and into tasks is bounded, however dirty the labels are.
MOST_LANGUAGES = 2_048
UNKNOWN = "und"
#: Letters whose n-grams are counted at a time.
PIECE = 400_000


class Space:
    """Vectors of letters; the same seed gives the same ones in every task."""

    def __init__(self, dimension: int = DIMENSION, seed: int = 3) -> None:
        self.dimension, self.seed = dimension, seed
        self.vectors: dict[int, np.ndarray] = {}
        self.letter: dict[int, bool] = {}

    def vector(self, letter: int) -> np.ndarray:
        if letter not in self.vectors:
            self.vectors[letter] = np.random.default_rng((self.seed, letter)).choice(np.array([-1, 1], np.int8), self.dimension)
        return self.vectors[letter]

    def letters(self, text: str) -> np.ndarray:
        """Code points of the text's letters, lower-cased, with one 0 between words and at either end; empty without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        used = np.unique(points)
        for p in used.tolist():
            if p not in self.letter:
                self.letter[p] = chr(p).isalpha()
        known = np.array([self.letter[p] for p in used.tolist()], bool)
        points = np.where(known[np.searchsorted(used, points)], points, 0).astype(np.uint32) if len(used) else points
        points = np.r_[np.uint32(0), points, np.uint32(0)]
        points = points[np.r_[True, (points[1:] != 0) | (points[:-1] != 0)]]
        return points if len(points) > 1 else points[:0]

    def bundles(self, texts: list[str]) -> np.ndarray:
        """A row per text; zero where it has no letter. Letters are taken PIECE at a time, so one long text needs no more memory than many short ones, but for its own letters."""
        out = np.zeros((len(texts), self.dimension), np.float32)
        pieces: list[tuple[int, np.ndarray]] = []
        held = 0
        for k, text in enumerate(texts):
            own = self.letters(text)
            for at in range(0, max(0, len(own) - GRAM + 1), PIECE):  # neighbours share GRAM - 1 letters, so each n-gram is in one piece
                pieces.append((k, own[at : at + PIECE + GRAM - 1]))
                held += len(pieces[-1][1])
                if held >= PIECE:
                    self._add(pieces, out)
                    pieces, held = [], 0
        if pieces:
            self._add(pieces, out)
        return out

    def _add(self, pieces: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        """Adds the bundles of pieces (row, letters) to the rows of out."""
        alphabet, dense = np.unique(np.concatenate([x for _, x in pieces]), return_inverse=True)
        sizes = np.array([len(x) for _, x in pieces])
        base = len(alphabet)
        code = np.zeros(len(dense) - GRAM + 1, np.int64)
        for k in range(GRAM):
            code = code * base + dense[k : len(dense) - GRAM + 1 + k]
        keep = np.ones(len(code), bool)
        for e in np.cumsum(sizes)[:-1].tolist():
            keep[max(0, e - GRAM + 1) : e] = False
        owner = np.repeat(np.arange(len(pieces)), sizes - GRAM + 1)
        grams, which = np.unique(code[keep], return_inverse=True)
        table = np.stack([self.vector(int(a)) for a in alphabet])
        rolled = [np.roll(table, k, axis=1) for k in range(GRAM)]
        pair, count = np.unique(owner * len(grams) + which, return_counts=True)
        row, gram = pair // len(grams), pair % len(grams)
        rows = np.array([k for k, _ in pieces])
        for at in range(0, len(grams), 4096):  # counts and vectors of some n-grams at a time
            rest = grams[at : at + 4096].copy()
            bound = np.ones((len(rest), self.dimension), np.int8)
            for k in range(GRAM):
                bound *= rolled[k][rest % base]
                rest //= base
            own = (gram >= at) & (gram < at + 4096)
            counts = np.zeros((len(pieces), len(rest)), np.float32)
            counts[row[own], gram[own] - at] = count[own]
            np.add.at(out, rows, counts @ bound.astype(np.float32))


def _runs(texts: list[str] | list[bytes], most: int = 400_000) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= most or k - at >= 63:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def units(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space, sums = Space(), {}
    for b in batches:
        texts, langs = b["text"].to_pylist(), b["lang"].to_pylist()
        for lo, hi in _runs(texts):
            for lang, v in zip(langs[lo:hi], units(space.bundles([t.decode("utf-8", "replace") for t in texts[lo:hi]])), strict=True):
                sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
    yield pa.record_batch({"lang": pa.array(list(sums), pa.string()), "profile": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})


def shares(counts: dict[str, int], total: int, least: int = LEAST_ROWS) -> dict[str, float]:
    """The share of each language's rows that is learnt from: all rows of small languages, as many of each of the others, `total` in all (or `least` each)."""
    rest, most = total, float("inf")
    for k, n in enumerate(sorted(counts.values())):
        if n * (len(counts) - k) > rest:
            most = max(rest / (len(counts) - k), least)
            break
        rest -= n
    return {lang: min(1.0, most / n) for lang, n in counts.items()}


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, parts: int = 16) -> dict[str, np.ndarray]:
    """Prototypes (unit vectors) by language from rows (doc_id, text, lang), of which a hash picks `sample_rows`, or a few of each language.

    Only rows whose text has a letter count. Every language that has one is learnt (of more than MOST_LANGUAGES those with
    the most rows): the row with its least hash is always picked. What comes to the driver is a count and `parts` vectors per language, whatever the size of the data.
    """
    size = 1 << 30
    h = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")), F.lit(size))
    labelled = labelled.where("lang is not null").where(F.col("text").cast("string").rlike(r"\p{L}")).select("lang", "text", h.alias("h"))
    found = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("first"))
    each = {r["lang"]: r for r in found.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    share = shares({k: r["n"] for k, r in each.items()}, sample_rows)
    if len(each) == MOST_LANGUAGES or any(x < 1 for x in share.values()):
        limits = labelled.sparkSession.createDataFrame([(k, max(int(x * size), each[k]["first"] + 1)) for k, x in share.items()], "lang string, most long")
        labelled = labelled.join(checked(limits), "lang").where(F.col("h") < F.col("most"))
    rows = labelled.select("lang", text_bytes().alias("text")).repartition(parts)
    found: dict[str, np.ndarray] = {}
    for r in to_python(rows).mapInArrow(lean(_profiles), "lang string, profile array<double>").collect():
        found[r["lang"]] = found.get(r["lang"], 0) + np.array(r["profile"])
    found = {k: v for k, v in sorted(found.items()) if np.linalg.norm(v)}
    return {k: units(v[None])[0].astype(np.float32) for k, v in found.items()}


OWN = ("lang_pred", "score")


def _classifier(prototypes: dict[str, np.ndarray], whole: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = list(prototypes)
    matrix = np.stack([prototypes[k] for k in names]) if names else np.zeros((0, DIMENSION), np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space()
        for b in batches:
            texts, pred, score = [t if isinstance(t, str) else (t or b"").decode("utf-8", "replace") for t in (b["row"].field("text") if whole else b["text"]).to_pylist()], [], []
            lettered: list[bool] = []
            for lo, hi in _runs(texts):
                bundles = space.bundles(texts[lo:hi])
                some = np.abs(bundles).sum(1) > 0
                lettered += some.tolist()
                if not names:
                    pred += [UNKNOWN] * (hi - lo)
                    score += [0.0] * (hi - lo)
                    continue
                cosine = units(bundles).astype(np.float64) @ matrix.T.astype(np.float64)
                best = cosine.argmax(1)
                pred += [names[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), some.tolist(), strict=True)]
                score += np.where(some, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0).tolist()
            own = [b["row"]] if whole else [b["doc_id"], b["held_out"]]
            yield pa.record_batch([*own, pa.array(pred, pa.string()), pa.array(score, pa.float64()), *([pa.array(lettered, pa.bool_())] * whole)], ["row", *OWN, "letters"] if whole else ["doc_id", "held_out", *OWN])

    return run


def held_out() -> Column:
    """Rows never learnt from: crc32 of doc_id as text leaves 1 by 3 (a null doc_id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score (the cosine, 0 to 1). Learns from rows that are not held out, unless prototypes are given.

    A text that is null or has no letter is `und` with score 0, and so is every text if nothing can be learnt. Repeated rows are read one by one; long texts are read whole. Equal
    cosines go to the first language by name. lang, source and doc_id play no part in a prediction. An empty table gives an
    empty result. Other columns are ignored.
    """
    if prototypes is None:
        prototypes = learn(docs.where(~held_out()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("text"))
    return to_python(rows).mapInArrow(lean(_classifier(prototypes)), "doc_id long, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, prototypes: dict[str, np.ndarray] | None = None) -> DataFrame:
    """row (a struct of all columns of docs), lang_pred, score and letters (whether the text has any, whatever could be learnt) per row of docs.

    The cases are those of identify(): null and letterless texts are `und`, repeated rows are read one by one, an empty table
    gives an empty result. Columns of docs may have any names, since they stay in their struct.
    """
    if prototypes is None:
        prototypes = learn(docs.where(~held_out()))
    rows = docs.select(whole(docs))
    found = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("letters", T.BooleanType())])
    return to_python(rows).mapInArrow(lean(_classifier(prototypes, True)), found)
