"""BPE encoding by a prefix-sharing trie traversal, and decoding.

The encoding of a string is known by its last token and the encoding of what stands before it, and that last token is the
one vocabulary entry that ends the string and may follow the last token of the rest: two tokens may stand side by side if
no merge across their border comes before the merges that made them. So the state of a prefix is its last token, and
states go from a prefix to the longer ones. Each batch's new distinct words are the leaves of a trie; in sorted order they
are its leaves depth first, so a walk that keeps the states of the current path computes each shared prefix once.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections import ChainMap
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import lean, text_bytes, to_python

#: The pre-tokenizer pattern that byte-level BPE files with use_regex stand for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose encodings a worker remembers at a time, and as many of those before; pairs of tokens that it remembers.
MEMORY = 160_000
PAIRS = 400_000
#: Letters of words that are remembered at all: longer ones are encoded for their batch alone, so what is remembered is bounded in bytes, too.
LONG = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A byte-level BPE vocabulary of the tokenizers library's JSON format."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        letters = byte_letters()
        vocab = config["model"]["vocab"]
        self.token: dict[bytes, int] = {bytes(letters[c] for c in word): i for word, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        size = max([*self.token.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for word, i in self.token.items():
            self.bytes[i] = word
        for word, i in self.special.items():
            self.bytes[i] = word.encode()
        self.reach: dict[bytes, int] = {}  # by the last three bytes: the longest token that ends in them
        for word in self.token:
            if len(word) > 2:
                self.reach[word[-3:]] = max(self.reach.get(word[-3:], 2), len(word))
        self.rank: dict[int, int] = {}  # of a pair of tokens that merge
        self.made: list[int] = []  # by rank: the token that comes of it
        self.born: dict[int, int] = {}  # of a token: the rank of the first merge that makes it
        self.halves: list[tuple[int, int]] = []
        for r, m in enumerate(config["model"]["merges"]):
            a, b = (vocab[x] for x in (m if isinstance(m, list) else m.split(" ")))
            c = self.token[self.bytes[a] + self.bytes[b]]
            self.rank[a << 20 | b] = r
            self.made.append(c)
            self.halves.append((a, b))
            self.born.setdefault(c, r)
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.apart: dict[int, bool] = {}  # of pairs that were asked for: may they stand side by side?
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """The pieces of t that stand at its border while it is merged: (piece, rank of the merge that takes it up)."""
        out = [(t, sys.maxsize)]
        while (r := self.born.get(t)) is not None:
            t = self.halves[r][side]
            out.append((t, r))
        return out

    def may_follow(self, t: int, u: int) -> bool:
        """Whether u may stand after t: no merge across their border comes before those that take up the pieces beside it."""
        left = self._edge(u, 0)
        for a, until_a in self._edge(t, 1):
            for b, until_b in left:
                r = self.rank.get(a << 20 | b)
                if r is not None and r < until_a and r <= until_b:
                    return False
        return True

    def merge(self, word: bytes) -> list[int]:
        """Plain merging, lowest rank and leftmost first."""
        parts = [self.token[word[i : i + 1]] for i in range(len(word))]
        while len(parts) > 1:
            r, i = min((self.rank.get(parts[i] << 20 | parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
            if r == sys.maxsize:
                break
            parts[i : i + 2] = [self.made[r]]
        return parts

    def encode_words(self, words: list[bytes], long: bool = False) -> Iterator[list[int]]:
        """Encodings of the sorted distinct words: a depth-first walk of their trie. long: keep the states of the path in arrays, which take less room than lists and a little more time."""
        token, may_follow, reach, apart = self.token.get, self.may_follow, self.reach.get, self.apart
        if len(apart) > PAIRS:
            apart.clear()
        last, length = (array("i", [-1]), array("i", [0])) if long else ([-1], [0])  # last[i]: the last token of the path's first i bytes
        before = b""
        for word in words:
            size, shared = len(word), 0
            for x, y in zip(before, word):  # noqa: B905
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], length[shared + 1 :]
            for end in range(shared + 1, size + 1):
                start = end - reach(word[end - 3 : end], 2) if end > 3 else 0
                if start < 0:
                    start = 0
                while True:
                    t = token(word[start:end])
                    if t is not None:
                        if start == 0:
                            break
                        pair = last[start] << 20 | t
                        ok = apart.get(pair)
                        if ok is None:
                            ok = apart[pair] = may_follow(last[start], t)
                        if ok:
                            break
                    start += 1
                    if start == end:
                        raise ValueError("the vocabulary has no token for a byte")
                last.append(t)
                length.append(end - start)
            before = word
            out, end = [], size
            while end:
                out.append(last[end])
                end -= length[end]
            yield out[::-1]

    def learn(self, words: set[str], known: dict[str, bytes], long: bool = False) -> None:
        """Adds the encodings of words, as bytes of unsigned 32-bit numbers, to known."""
        new, packed = sorted([(w.encode(), w) for w in words]), self.packed
        for (_, w), ids in zip(new, self.encode_words([b for b, _ in new], long), strict=True):
            known[w] = b"".join([packed[i] for i in ids])

    def pieces(self, text: str) -> list[list[str] | int]:
        """The text cut at special tokens (as ids) and into words."""
        if self.split_special is None or not any(s in text for s in self.special):
            return [self.words.findall(text)]
        return [self.special[x] if k % 2 else self.words.findall(x) for k, x in enumerate(self.split_special.split(text))]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of unsigned 32-bit numbers, lowest byte first."""
        cut = [self.pieces(t) for t in texts]
        seen: set[str] = set()
        for text in cut:
            for part in text:
                if not isinstance(part, int):
                    seen.update(part)
        if len(self.known) > MEMORY:  # words that are still in use come back from there
            self.older, self.known = self.known, {}
        known = self.known
        new = seen - known.keys()
        back = new & self.older.keys()
        known.update(zip(back, map(self.older.__getitem__, back), strict=True))
        new -= back
        long = {w for w in new if len(w) > LONG}
        self.learn(new - long, known)
        if long:
            once: dict[str, bytes] = {}
            self.learn(long, once, True)
            known = ChainMap(once, known)
        ids = known.__getitem__
        return [b"".join([part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(ids, part)) for part in text]) for text in cut]

    def decode(self, ids: bytes) -> str:
        table = self.bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@cache
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def chunks(texts: list[bytes], most: int = 1_000_000) -> Iterator[list[bytes]]:
    """The texts in runs of about so many bytes."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t)
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


def _encoder(path: str, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for b in batches:
            at = 0
            for run in chunks(b["text"].to_pylist()):
                texts = [t.decode("utf-8", "replace") for t in run]
                ids = bpe.encode_batch(texts)
                decoded = [bpe.decode(x) for x in ids]
                columns = {
                    "doc_id": b["doc_id"].slice(at, len(run)), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in decoded], pa.string()),
                }
                if keep_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array(decoded, pa.string())
                at += len(run)
                yield pa.record_batch(columns)

    return run


def bpe_encode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids also ids and decoded.

    Null and empty texts have no tokens; long ones are encoded whole. The strings of special tokens in a text are those tokens. Nothing is truncated.
    Repeated rows are encoded one by one. An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return to_python(rows).mapInArrow(lean(_encoder(path, keep_ids)), schema)
