"""The operators against brute force on small hand-made tables: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import bpe, common, embeddings, exact_dedup, language, licenses, mixing, pii, sharding, simhash, substring
from tributary.llm.common import components

WS = re.compile(r"[\x20\x09-\x0D]+")
#: Columns named like those that operators make for themselves.
CLASH = "uid long, key long, norm string, id long, th long, h long, size long, bucket int, pass int, shard int, slot long, fp long, row long, _uid long, kept boolean"
SCHEMA = f"doc_id long, text string, lang string, source string, {CLASH}"


def words(t):
    return [w for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]


def table(spark, rows):
    """rows of (doc_id, text, lang, source)"""
    return spark.createDataFrame([(*r, *[None] * 14, True) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = text(120), text(60)
    out = [(k, text(rng.randint(1, 150)), "en", f"src{k % 3}") for k in range(40)]
    out += [(40 + k, base, "en", "hot") for k in range(30)]  # copies
    out += [(70 + k, base.replace(" ", " \t\n"[k % 3] * (1 + k % 2)), "en", "hot") for k in range(5)]  # equal but for white space
    for k in range(25):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append((80 + k, " ".join(w), "fr", "hot"))
    out += [(110 + k, f"{text(20)} {passage} {text(15)}", "de", None) for k in range(10)]  # a shared passage
    out += [(130, None, None, None), (131, "", "en", ""), (132, "  \t ", None, "x"), (133, "a\x85b c", "en", "x"), (134, "one", "en", "x"), (135, "1234 !!", "en", "x")]
    out += [(40, base, "en", "hot"), (40, base, "en", "hot"), (None, base, "en", "hot"), (None, "lonely text", "en", "x"), (5, "same id, other text", "en", "src2")]
    out.append((140, " ".join(["same"] * 3_000), "en", "long"))
    out.append((141, text(4_000), "en", "long"))
    return out


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_exact_dedup(spark, rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[WS.sub(" ", t or "")].append(i)
    want = Counter((i, min(x for x in groups[n] if x is not None) if any(x is not None for x in groups[n]) else None, len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for n, ids in groups.items() for i in ids)
    for settings in ({}, {"capacity": 3, "max_depth": 6}, {"key_bits": 4, "capacity": 2}):  # the last: nearly all keys collide
        out = exact_dedup.exact_dedup(table(spark, rows), **settings).cache()
        assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == want
        kept = out.where("kept")
        assert kept.count() == len(groups) == kept.select("text_sha256").distinct().count()
        assert kept.where("not (doc_id <=> keep_id)").count() == 0
    assert exact_dedup.exact_dedup(table(spark, rows).limit(0)).count() == 0


def test_directory_doubles():
    depth, buckets = exact_dedup.grow_directory({0: 10, 1: 1, 7: 1}, capacity=5, max_depth=3)
    assert depth == 3 and buckets == [(0, 3), (1, 3), (1, 2), (1, 1)]  # prefix 000 stays overfull: a chain
    assert exact_dedup.grow_directory({}, 5, 3) == (0, [(0, 0)])


def feistel(x, n, seed):
    """The same permutation in plain Python."""
    h = lambda *v: _spark_hash(v)
    a, b = sharding.domain(n)
    while True:
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + h(right, seed * 1_000_003 + i) % a) % a
            else:
                right = (right + h(left, seed * 1_000_003 + i) % b) % b
        x = left * b + right
        if x < n:
            return x


def _spark_hash(values):
    seed = 42
    for k, v in enumerate(values):
        width = 8 if k == 0 else 4  # the round key is an int literal
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed) if width == 8 else _hash_int(int(v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _hash_int(v, seed):
    return xxhash.xxh64_intdigest((v & 0xFFFFFFFF).to_bytes(4, "little"), seed)


def test_sharding(spark, rows):
    out = [r.asDict() for r in sharding.shard(table(spark, rows), 7).collect()]
    n = len(rows)
    assert len(out) == n and {r["law"] for r in out} == {"rows"} and all(r["grown_shard"] is None for r in out)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert all(feistel(r["row"], n, 7) == r["slot"] * 7 + r["shard"] for r in out)
    ids = [r["doc_id"] for r in sorted(out, key=lambda r: r["row"])]
    assert ids == sorted([i for i in ids if i is not None]) + [None, None]
    again = sharding.shard(table(spark, rows).repartition(7), 7)
    assert got(again, "doc_id", "shard", "slot", "text_crc32") == Counter((r["doc_id"], r["shard"], r["slot"], r["text_crc32"]) for r in out)
    assert sharding.shard(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one(spark, n):
    assert sorted(r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 3)).collect()) == list(range(n))


def water(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target | {s: float(cap * sizes[s]) for s in capped}
        capped |= over


def md5_key(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def mix_by_hand(docs, cut=True, shards=16, seed=11):
    """For each of docs (doc_id, text, source) its draws (pass, shard, words, place), from the description of the mix: a node's tickets are split in Python lists."""
    docs = [(i, len(words(t)), s, md5_key(seed, "" if i is None else i)) for i, t, s in docs]
    by = defaultdict(list)
    for k, (_, _, s, _) in enumerate(docs):
        by[s].append(k)
    total = sum(n for _, n, _, _ in docs)
    target = water({s: sum(docs[k][1] for k in own) for s, own in by.items()})
    blocks, buckets, passes, held, rest, extra = min(65_536, max(256, len(docs) // 2_000)), {}, {}, {}, {}, {}
    for s, own in by.items():
        size = sum(docs[k][1] for k in own)
        quota = min(int(target[s] + 0.5), 3 * size)
        passes[s], rest[s] = divmod(quota, size) if size else (0, 0)
        buckets[s] = max(1, -int(-(float(size) * float(blocks) / float(max(total, 1))) // 1))
        held[s] = [0] * buckets[s]
        for k in own:
            held[s][docs[k][3] % buckets[s]] += docs[k][1]
        extra[s] = sum(sum(held[s][:b]) < rest[s] for b in range(buckets[s]))
    tickets = [(s, k) for s in by for k in range(passes[s] * buckets[s] + extra[s])]
    tickets.sort(key=lambda t: md5_key(f"{seed}:tree", "" if t[0] is None else t[0], str(t[0] is None).lower(), t[1]))
    quota = Counter()

    def node(tickets, low, high):
        if high - low == 1:
            quota.update((s, low) for s, _ in tickets)
            return
        mid = low + (high - low) // 2
        left = len(tickets) * (mid - low) // (high - low)
        node(tickets[:left], low, mid)
        node(tickets[left:], mid, high)

    node(tickets, 0, shards)
    out = [[] for _ in docs]
    for s, own in by.items():
        at = 0
        for shard in range(shards):
            for place in range(at, at + quota[s, shard]):
                turn, bucket = divmod(place, buckets[s])
                members = [(md5_key(seed, shard, turn, docs[k][3]), docs[k][3], docs[k][0] or -1, docs[k][1], k) for k in own if docs[k][3] % buckets[s] == bucket]
                before = sum(held[s][:bucket])
                room = rest[s] - before if turn == passes[s] and before < rest[s] < before + held[s][bucket] else None
                for key, _, _, size, k in sorted(members):
                    if room is None:
                        out[k].append((turn, shard, size, key))
                    else:
                        part = max(0, min(size, room)) if cut else size if room * 2 >= size and room > 0 else 0
                        out[k] += [(turn, shard, part, key)] if part else []
                        room -= size
            at += quota[s, shard]
    return [sorted(x) for x in out]


def test_mixing(spark, rows):
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = water(sizes)
    out = mixing.mix(table(spark, rows)).cache()
    by_hand = mix_by_hand([(i, t, s) for i, t, _, s in rows])
    listed = lambda x, k: ",".join(str(d[k]) for d in x)
    assert got(out, "doc_id", "size", "source_size", "taken", "shards", "places") == Counter((i, len(words(t)), sizes[s], sum(d[2] for d in x), listed(x, 1), listed(x, 3)) for (i, t, _, s), x in zip(rows, by_hand, strict=True))
    taken = Counter()
    for (_, t, _, s), x in zip(rows, by_hand, strict=True):
        taken[s] += sum(d[2] for d in x)
        assert sum(d[2] for d in x) <= 3 * len(words(t))
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert all(min(abs(r["target"] - x) for x in want.values()) < 1e-6 for r in out.collect())
    again = mixing.mix(table(spark, rows).repartition(5))
    assert got(again, "doc_id", "size", "taken", "shards") == got(out, "doc_id", "size", "taken", "shards")
    assert mixing.mix(table(spark, rows).limit(0)).count() == 0
    assert mixing.mix(table(spark, [(1, None, None, "a"), (2, "", None, "b")])).where("taken = 0 and target = 0").count() == 2


def test_mixed_rows(spark, rows):
    """The rows themselves, whole, in their shards, each shard in the order of its draws."""
    placed = mixing.arranged(table(spark, rows), named="shard")
    assert placed.columns == [*table(spark, rows).columns, "shard_"]
    want = Counter((i, t, d[1]) for (i, t, _, s), x in zip(rows, mix_by_hand([(i, t, s) for i, t, _, s in rows], cut=False), strict=True) for d in x)
    assert got(placed, "doc_id", "text", "shard_") == want
    key = {(r["doc_id"], r["text"]): None for r in placed.collect()}
    assert len(key) > 50 and mixing.mixed(table(spark, rows)).columns == table(spark, rows).columns
    one = mixing.arranged(table(spark, rows), named="shard", shards=4).collect()
    spots = {(r["doc_id"], r["text"], r["shard_"]) for r in one}
    by_hand = mix_by_hand([(i, t, s) for i, t, _, s in rows], cut=False, shards=4)
    order = {(i, t, d[1]): d[3] for (i, t, _, _), x in zip(rows, by_hand, strict=True) for d in x}
    assert spots == set(order)
    for shard in range(4):  # a shard is one piece here, so its rows come in its order
        keys = [order[r["doc_id"], r["text"], shard] for r in one if r["shard_"] == shard]
        assert keys == sorted(keys)
    whole = mixing.PIECE_WORDS
    try:
        mixing.PIECE_WORDS = 300  # pieces by size: each is in order, and a task has one of them
        out = mixing.arranged(table(spark, rows), named="shard", shards=4)
        assert out.rdd.getNumPartitions() > 8 and {(r["doc_id"], r["text"], r["shard_"]) for r in out.collect()} == spots
        for part in out.rdd.glom().collect():
            keys = [order[r["doc_id"], r["text"], r["shard_"]] for r in part]
            assert keys == sorted(keys) and len({r["shard_"] for r in part}) <= 1
    finally:
        mixing.PIECE_WORDS = whole
    assert mixing.mixed(table(spark, rows).limit(0)).count() == 0


def test_splitting_tree(spark):
    tickets = spark.createDataFrame([(s, k) for s, n in (("a", 40), ("b", 20), (None, 4)) for k in range(n)], "source string, ticket long")
    out = mixing.split(tickets, 8, 1).collect()
    assert Counter(r["shard"] for r in out) == {k: 8 for k in range(8)} and sorted(r["rank"] for r in out) == list(range(64))
    assert Counter(r["source"] for r in out) == {"a": 40, "b": 20, None: 4}
    quotas = mixing.leaf_quotas(mixing.split(tickets, 8, 1)).collect()
    assert sum(r["quota"] for r in quotas if r["source"] == "a") == 40 and all(r["first"] == sum(q["quota"] for q in quotas if q["source"] == r["source"] and q["shard"] < r["shard"]) for r in quotas)
    # over many seeds a shard gets each source's share on average, with the spread of draws without replacement
    draws = [sum(r["source"] == "a" for r in mixing.split(tickets, 2, s).where("shard = 0").collect()) for s in range(12)]
    assert abs(np.mean(draws) - 20) < 2.5 and 0.5 < np.std(draws) < 4.5


def test_targets_of_many_sources(spark):
    rng = random.Random(12)
    sizes = {f"s{k:04d}": rng.choice([0, 1, 3, 10, 1_000, 50_000]) * rng.randint(1, 9) for k in range(400)} | {None: 7}
    out = mixing.targets(spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, source_rows long, words long")).collect()
    want = water(sizes)
    assert len(out) == len(want) and all(abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) for r in out)


def fingerprint(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def union(n, pairs):
    up = list(range(n))
    for a, b in pairs:
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    for k in range(n):
        up[k] = up[up[k]] if up[up[k]] == up[up[up[k]]] else union_top(up, k)
    return up


def union_top(up, k):
    while up[k] != k:
        k = up[k]
    return k


def test_simhash(spark, rows):
    fps = [fingerprint(t) for _, t, *_ in rows]
    tops = [union_top(u, k) for u in [union(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])] for k in range(len(rows))]
    least = {}
    for top, (i, *_) in zip(tops, rows, strict=True):
        least[top] = min((x for x in (least.get(top), i) if x is not None), default=None)
    out = simhash.simhash_dedup(table(spark, rows)).cache()
    assert got(out, "doc_id", "fingerprint", "component_id") == Counter((r[0], f"{f:016x}", least[t]) for r, f, t in zip(rows, fps, tops, strict=True))
    assert out.where("kept").count() == len(least)
    assert simhash.simhash_dedup(table(spark, rows).limit(0)).count() == 0


def test_golay_keys():
    """Words at 2 bits or less share a nearby codeword; at 1 bit or less, the one's home is near the other."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 4000)
    for e in (0, 1, 2):
        y = x.copy()
        for _ in range(e):
            y ^= 1 << rng.integers(0, 23, len(y))
        a, b = simhash.codewords(x), simhash.codewords(y)
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).all()
        if e < 2:
            assert (b[:, :1] == a).any(1).all() and (a[:, :1] == b).any(1).all()


@pytest.mark.parametrize("block", [20_000, 3])
def test_simhash_links_of_random_neighbours(spark, block):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = [*base]
    for b in base[:40]:
        for k in range(6):
            f = b
            for bit in rng.choice(64, k, replace=False):
                f ^= np.uint64(1) << np.uint64(bit)
            fps.append(f)
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    forest = simhash.Forest()
    for a, b in (tuple(map(int, r)) for r in simhash.links(df, block).collect()):
        assert (a ^ b & ((1 << 64) - 1)) is not None and int(np.bitwise_count(np.int64(a).view(np.uint64) ^ np.int64(b).view(np.uint64))) <= 4
        forest.add(a, b)
    want = simhash.Forest()
    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4), strict=True):
        if i < j:
            want.add(int(fps[i].view(np.int64)), int(fps[j].view(np.int64)))
    ids = fps.view(np.int64).tolist()
    assert [forest.top(x) for x in ids] == [want.top(x) for x in ids]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_crowded_keys(spark, monkeypatch, how):
    """Rows are looked up the same way whether the table is broadcast, or only its crowded keys, or none of them."""
    rng = random.Random(18)
    rows = [(k, rng.choice([7] * 8 + list(range(40)))) for k in range(500)] + [(1000, None)]
    many = Counter(x for _, x in rows)
    table_ = [(x, f"v{x}", many[x]) for x in many if x is not None and x % 3]
    known = {x: v for x, v, _ in table_}
    left, right = spark.createDataFrame(rows, "uid long, x long").repartition(5), spark.createDataFrame(table_, "x long, v string, n long")
    want = Counter((k, x, known.get(x)) for k, x in rows if how == "left" or x in known)
    for hot, most in ((50_000, 1 << 20), (500, 0), (20, 0), (1, 0)):
        with monkeypatch.context() as m:
            m.setattr(common, "HOT", hot)
            m.setattr(common, "checked", lambda df, *a, most=most, real=common.checked: real(df) if most else df)
            assert got(common.looked_up(left, right, ["x"], "n", how), "uid", "x", "v") == got(common.looked_up(left, right, ["x"], "n", how, False), "uid", "x", "v") == want


def test_one_group_holds_most_rows(spark, monkeypatch):
    """Copies, wordless texts, one passage and one source that most rows have, without any broadcast of what is looked up."""
    rng = random.Random(19)
    text = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(n))
    base, passage = text(130), text(60)
    rows = [(k, base, "en", "hot") for k in range(300)] + [(300 + k, None if k % 2 else " ", "en", "hot") for k in range(60)] + [(400 + k, f"{text(9)} {passage} {text(9)}", "en", "hot") for k in range(200)] + [(700 + k, text(70), "en", f"s{k % 3}") for k in range(30)]
    monkeypatch.setattr(common, "HOT", 50)
    for module in (common, exact_dedup, mixing, simhash, substring):
        monkeypatch.setattr(module, "checked", lambda df, *a: df)
    groups = Counter(WS.sub(" ", t or "") for _, t, *_ in rows)
    out = exact_dedup.exact_dedup(table(spark, rows)).collect()
    assert Counter(r["group_size"] for r in out) == Counter(groups[WS.sub(" ", t or "")] for _, t, *_ in rows) and sum(r["kept"] for r in out) == len(groups)
    near = simhash.simhash_dedup(table(spark, rows)).collect()
    assert {r["component_id"] for r in near if r["doc_id"] < 300} == {0} and {r["component_id"] for r in near if 300 <= r["doc_id"] < 360} == {300}
    assert got(substring.substring_dedup(table(spark, rows), with_text=True), *CUT) == without_repeats(rows)
    by_hand = mix_by_hand([(i, t, s) for i, t, _, s in rows])
    assert got(mixing.mix(table(spark, rows)), "doc_id", "taken") == Counter((i, sum(d[2] for d in x)) for (i, *_), x in zip(rows, by_hand, strict=True))


def test_components(spark):
    chain = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    out = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert out == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            center = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, (center + rng.standard_normal(16) * 0.07).astype(np.float32).tolist(), label))
                k += 1
    v = rows[0][1]
    rows += [(1000, v, 0), (1001, v, 0), (1002, v, 1), (1003, [x * 2 for x in v], 0), (1004, None, 0), (1005, [0.0] * 16, 0), (1006, [float("nan"), *v[1:]], 0), (1007, [None, *v[1:]], 0), (1008, [float("inf"), *v[1:]], 0), (1009, [], 0), (1010, v[:8], 0), (1000, v, 0)]
    fine = lambda r: r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    n, cos = len(rows), lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    pairs = [(i, j) for i in range(n) for j in range(i) if fine(rows[i]) and fine(rows[j]) and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and cos(np.array(rows[i][1], float), np.array(rows[j][1], float)) >= 0.98]
    degree, up = Counter(x for p in pairs for x in p), union(n, pairs)
    least = {}
    for i in range(n):
        t = union_top(up, i)
        least[t] = min(least.get(t, rows[i][0]), rows[i][0])
    want = Counter((rows[i][0], degree[i], least[union_top(up, i)], rows[i][0] == least[union_top(up, i)]) for i in range(n))
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, label int, node long, i int, own string")
    for block in (2048, 5):
        assert got(embeddings.embedding_dedup(df, block=block), "vec_id", "n_links", "component_id", "kept") == want
    assert embeddings.embedding_dedup(df.limit(0)).count() == 0


def test_embeddings_of_any_magnitude(spark):
    """Norms beyond what doubles hold: directions count alone."""
    v = [0.3, -0.2, 0.9, 0.1]
    rows = [(k, [x * s for x in v], "a") for k, s in enumerate((1.0, 1e200, 1e-200, 1e300, 1e-300, -1.0))]
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert out == {k: (4, 0) for k in range(5)} | {5: (0, 5)}


def test_estimates_are_unbiased():
    """Over random rotations the estimate's mean is the cosine, and the bound holds."""
    rng = np.random.default_rng(4)
    o = rng.standard_normal(64)
    q = o + rng.standard_normal(64) * 0.8
    o, q = o / np.linalg.norm(o), q / np.linalg.norm(q)
    est = []
    for seed in range(400):
        turn = embeddings.rotation(64, seed)
        code, factor, _ = embeddings.encode(o[None], turn)
        query, step, lost = embeddings.quantised((turn @ q)[None])
        b = embeddings.products(code, query, step)[0, 0]
        est.append(b / factor[0])
        assert abs(b - np.sign(turn @ o) @ (turn @ q) / 8) <= lost[0] + 1e-6 and lost[0] < 0.02
        assert len(next(embeddings.open_pairs(code, factor, query, step, lost, float(o @ q), False))[0]) == 1
    assert abs(np.mean(est) - o @ q) < 4 * np.std(est) / 20


def test_few_pairs_are_recomputed():
    """All pairs at or over the threshold are open, and hardly any other is."""
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.standard_normal((40, 64)) * 0.02 * k for k, c in enumerate(rng.standard_normal((50, 64)))])
    x = embeddings.units(x)
    code, factor, turned = embeddings.encode(x, embeddings.rotation(64))
    found = np.zeros((len(x), len(x)), bool)
    for i, j in embeddings.open_pairs(code, factor, *embeddings.quantised(turned), 0.98, True):
        found[i, j] = True
    link = np.triu(x @ x.T >= 0.98, 1)
    near = np.triu(x @ x.T >= 0.6, 1)
    assert link.sum() > 1_000 and not (link & ~found).any() and (found & ~near).sum() < 1e-4 * len(x) ** 2


def test_classes():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 200, (2, 120))
    c = embeddings.Classes(200)
    for k in range(0, 120, 30):
        c.join(a[k : k + 30], b[k : k + 30])
    up = union(200, list(zip(a.tolist(), b.tolist(), strict=True)))
    tops = [union_top(up, k) for k in range(200)]
    assert c.least.tolist() == [min(k for k in range(200) if tops[k] == t) for t in tops]


def test_bpe(spark, rows):
    extra = [(900, "<|endoftext|> a<|endoftext|>b <|endoftext", "en", "x"), (901, "日本語 😀 ñandú\x00\x85", "en", "x"), (902, "x" * 5_000, "en", "x"), (903, " " * 700 + "\n\n a", "en", "x")]
    reference = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = Counter()
    for i, t, *_ in [*rows, *extra]:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    out = bpe.bpe_encode(table(spark, [*rows, *extra]), path)
    assert got(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    full = bpe.bpe_encode(table(spark, extra), path, keep_ids=True).where("doc_id = 901").first()
    assert full["decoded"] == extra[1][1] and full["ids"] == reference.encode(extra[1][1]).ids
    assert bpe.bpe_encode(table(spark, rows).limit(0), path).count() == 0


def test_bpe_words():
    """Any string: the trie's states give what plain merging gives."""
    b = bpe.Bpe(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(6)
    some = sorted({"".join(rng.choice("etaoinshr lé'0") for _ in range(rng.randint(1, 30))).encode() for _ in range(3_000)})
    assert list(b.encode_words(some)) == [b.merge(w) for w in some] == list(b.encode_words(some, long=True))


def pii_base(t):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base():
    rng = random.Random(7)
    for _ in range(20_000):
        t = "".join(rng.choice("ab@@..-+12 0(%é") for _ in range(rng.randint(0, 30)))
        assert pii.detect(t) == pii_base(t)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail bob (at) example (dot) com now", "email", "bob (at) example (dot) com"), ("write to jane[at]mail[dot]example[dot]org", "email", "jane[at]mail[dot]example[dot]org"),
        ("so bob at example dot com", "email", "bob at example dot com"), ("bоb@exаmple.com", "email", "bоb@exаmple.com"), ("on １９２.168.0.1!", "ip", "１９２.168.0.1"),
        ("call +four one five five five one two three four five now", "phone", "+four one five five five one two three four five"), ("pay 4111​1111​1111​1111 ok", "card", "4111​1111​1111​1111"),
    ],
)
def test_pii_disguises(text, kind, found):
    base, spans = pii.find(text)
    assert [(k, text[s:e]) for k, s, e in spans if (k, s, e) not in base] == [(kind, found)]


@pytest.mark.parametrize("text", ["the cat sat at home", "one two three, four", "sat at home dot done", "le naïve café", "zero trust. one at a time (at last)"])
def test_pii_leaves_clean_text_alone(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("at", ["@", " (at) ", "[at]", " at "])
@pytest.mark.parametrize("dots", [(".", " dot "), (" dot ", "."), (" dot ", " dot "), ("[dot]", " dot "), (" dot ", " (dot) "), (".", "[dot]")])
@pytest.mark.parametrize("ending", ["com", "nl", "it", "ch", "ai"])
def test_pii_mixed_addresses(at, dots, ending):
    name = f"some.one{at}mail{dots[0]}example{dots[1]}{ending}"
    base, spans = pii.find(f"so {name}, as ever")
    assert ("email", 3, 3 + len(name)) in spans and len(spans) == len(base) + 1


@pytest.mark.parametrize("text", ["someone (at) example dot com", "someone at example [dot] com", "someone@example dot com", "x at example dot nl", "jane dot doe (at) example dot foo", "x at example dot com dot au"])
def test_pii_whole_addresses(text):
    assert pii.find(f"to {text}.") == ([], [("email", 3, 3 + len(text))])


@pytest.mark.parametrize("text", ["10 dot 0 dot 0 dot 1", "10 (dot) 0 dot 0.1", "one nine two dot one six eight dot zero dot one"])
def test_pii_worded_ips(text):
    assert pii.find(f"on {text} now") == ([], [("ip", 3, 3 + len(text))])


@pytest.mark.parametrize("text", ["a talk at example.com", "look at the dot in the middle", "sat at home dot done", "at 3 dot 5 percent", "connect dot one at a time", "arrived at boiling point in time", "un point de vue", "us @ home . then"])
def test_pii_leaves_words_alone(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize(("text", "kind"), [("jean arobase example.com", "email"), ("pepe ARROBA ejemplo.es", "email"), ("hans ät beispiel.de", "email"), ("+3 one 4 five 9 two 6 five 3 5", "phone"), ("+fİve sİx seven one two three four five six", "phone")])
def test_pii_disguises_that_show_nothing_else(text, kind):
    """No bracket, worded dot or pair of spelled digits beside the disguise; a dotted capital I in a digit's name."""
    assert pii.find(f"to {text}, then") == ([], [(kind, 3, 3 + len(text))])


def test_pii_early_exit_loses_nothing():
    """What is told to have no disguise is what no transducer changes."""
    rng = random.Random(16)
    some = [*pii.DIGITS, *pii.TIMES, *pii.PLUS_WORDS, *pii.AT_WORDS, *pii.DOT_WORDS, "@", ".", "+", "(", ")", "[", "1", "23", "bob", "example", "com", "de"]
    left = 0
    for _ in range(20_000):
        text = "".join(rng.choice([str.lower, str.upper])(rng.choice(some)) + rng.choice(["", " ", " ", " ", "  ", "-", "."]) for _ in range(rng.randint(1, 8)))
        if pii.normalise(text) is None:
            left += 1
            tape = pii.Tape(text)
            assert not (pii.characters(text) or pii.marks(text) or pii.addresses(tape) or pii.worded_dots(text) or pii.numbers(text)), text
    assert left > 5_000
    text = "+one" + " 1" * 500_000 + " one x"
    began = time.process_time()
    pii.find(text)
    assert time.process_time() - began < 15


class PlainTape:
    """The definition of the rewritten text's offsets: a source stretch per character."""

    def __init__(self, text):
        self.text, self.of = text, [(k, k + 1) for k in range(len(text))]

    def rewrite(self, edits):
        for lo, hi, new in reversed(edits):
            self.of[lo:hi] = [(self.of[lo][0], self.of[hi - 1][1])] * len(new)
            self.text = self.text[:lo] + new + self.text[hi:]


def test_pii_offsets():
    """Rewritten texts stand for the same source stretches as when each character carries its own."""
    rng = random.Random(14)
    for _ in range(3_000):
        text = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 30)))
        tape, plain = pii.Tape(text), PlainTape(text)
        for turn in range(4):
            at, edits = 0, []
            while at < len(tape.text):
                at += rng.randint(0, 4)
                hi = at + rng.randint(1, 3)
                if hi <= len(tape.text):
                    edits.append((at, hi, rng.choice(["", "X", "Y"] if turn < 3 else ["", "Z", "555"])))
                at = hi
            tape.rewrite(edits)
            plain.rewrite(edits)
            assert tape.text == plain.text
            for lo in range(len(tape.text)):
                hi = rng.randint(lo + 1, len(tape.text))
                assert tape.source(lo, hi) == (plain.of[lo][0], plain.of[hi - 1][1])


def disguise(rng):
    """(kind, disguised text) of made-up personal data in one of the disguises that are claimed to be undone."""
    names = [n.split() for n in pii.DIGIT_NAMES]
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    spell = lambda digits, n, gap: gap.join(n[int(d)] for d in digits)
    kind = rng.choice(pii.KINDS)
    if kind == "email":
        at = rng.choice([" (at) ", "[at]", "{at}", "(at)", " [ät] ", " arobase ", " arroba ", "&#64;", "&#x40;", "&commat;", "＠", "@"])
        dot = rng.choice([" (dot) ", "[dot]", " dot ", "(punkt)", " punto ", "[point]", "&#46;", "&period;", "․"])
        if rng.random() < 0.1:
            at, dot = " at ", rng.choice([" dot ", " (dot) ", "[dot]"])
        return kind, f"{word()}{rng.choice(['', '.', '_'])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"
    language, gap = rng.choice(names), rng.choice([" ", "-", "  "])
    if kind == "ip":
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        how = rng.randrange(3)
        if how == 0:
            return kind, rng.choice([" dot ", "[.]", "(dot)", " punkt ", " (punto) "]).join(parts)
        if how == 1:
            return kind, f" {rng.choice(pii.DOT_WORDS)} ".join(spell(p, language, " ") for p in ("1" + parts[0][:1] + "0", "10", parts[2], "11"))
        return kind, "".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in ".".join(parts))
    if kind == "card":
        digits = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
        digits += next(str(d) for d in range(10) if pii.luhn(digits + str(d)))
        return kind, rng.choice([spell(digits, language, gap[:1]), "\u200b".join(digits[k : k + 4] for k in (0, 4, 8, 12)), "".join(chr(ord(c) + 0xFEE0) for c in digits), " ".join("\u2060".join(digits[k : k + 4]) for k in (0, 4, 8, 12))])
    digits = "".join(str(rng.randint(0, 9)) for _ in range(rng.randint(9, 12)))
    doubled = " ".join(["double " + names[0][int(digits[0])], spell(digits[2:], names[0], " ")])
    return kind, rng.choice(["+" + spell(digits, language, " "), "plus " + spell(digits, names[0], " "), "+" + doubled, "+" + "‑".join([digits[:3], digits[3:]]), "＋" + digits])


def test_pii_planted():
    """Disguises that are planted amid words are found, at their very places, and nothing else is."""
    rng = random.Random(15)
    fill = lambda: " ".join(rng.choice("the at of dot. le la point un der die das el en at, on and".split()) for _ in range(rng.randint(3, 12)))
    hit, extra, n = 0, 0, 3_000
    for _ in range(n):
        kind, said = disguise(rng)
        text = f"{fill()}: {said}; {fill()}"
        at = text.index(": ") + 2
        _, spans = pii.find(text)
        hit += (kind, at, at + len(said)) in spans
        extra += sum(not (at <= s and e <= at + len(said)) for _, s, e in spans)
    assert hit / n >= 0.97 and extra / n <= 0.01, (hit / n, extra / n)
    assert not sum(len(pii.find(fill())[1]) for _ in range(3_000))


@pytest.mark.parametrize("part", [" ", "( at ", "a@b.com ", "one 1 ", "x dot ", "bob at b dot com ", "double ", "[ ", "a@", "+1 ", "1 ", "&#", "é@. ", "bob (at) b (dot) com "])
def test_pii_long_texts(part):
    """Time goes with the length: a megabyte of anything is done in seconds."""
    text = part * (1_000_000 // len(part)) + " x (at) y (dot) com"
    began = time.process_time()
    assert any(k == "email" and e == len(text) for k, _, e in pii.find(text)[1])
    assert time.process_time() - began < 15


def test_pii_query(spark, rows):
    more = [(800, "a b@c.de 1.2.3.4 x", "en", "x"), (801, "4111 1111 1111 1111 +1 (743) 555-3824", "en", "x")]
    out = {r["doc_id"]: r for r in pii.find_pii(table(spark, [*rows, *more])).where("doc_id >= 100").collect()}
    for i, t, *_ in [*rows, *more]:
        if i and i >= 100:
            base = ",".join(f"{k}:{s}:{e}" for k, s, e in pii_base(t or ""))
            assert out[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and out[i]["spans"] == base
    assert (out[801]["n_card"], out[801]["n_phone"], out[800]["n_email"], out[800]["n_ip"]) == (1, 1, 1, 1)
    assert pii.find_pii(table(spark, rows).limit(0)).count() == 0


def without_repeats(rows):
    """(doc_id, n_words, n_removed, sha of what is kept, kept) of each row, by brute force."""
    first = {}
    for i, t, *_ in rows:
        w, at = words(t), i if i is not None else 1 << 62
        for p in range(len(w) - 49):
            k = tuple(w[p : p + 50])
            first[k] = min(first.get(k, at), at)
    want = Counter()
    for i, t, *_ in rows:
        w, at = words(t), i if i is not None else 1 << 62
        gone = {q for p in range(len(w) - 49) if first[tuple(w[p : p + 50])] < at for q in range(p, p + 50)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept] += 1
    return want


CUT = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")


def test_substring(spark, rows):
    want = without_repeats(rows)
    for batches in (1, 4):
        assert got(substring.substring_dedup(table(spark, rows), batches, with_text=True), *CUT) == want
    assert substring.substring_dedup(table(spark, rows).limit(0)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tributary_run_")]


def test_substring_compares_words(spark, rows):
    """Under hashes of a few bits nearly all windows seem equal: words tell that they are not, and other hashes are taken."""
    out = substring.substring_dedup(table(spark, rows), with_text=True, attempts=(3, 64))
    assert got(out, *CUT) == without_repeats(rows)
    with pytest.raises(RuntimeError, match="anew"):
        substring.substring_dedup(table(spark, rows), attempts=(3,))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tributary_run_")]


def test_substring_index_outlives_a_call(spark, rows, tmp_path, monkeypatch):
    """Three tables one after the other, each against the index alone, give what they give as one; a call that fails changes nothing."""
    base = words(rows[40][1])
    more = [*rows, (150, " ".join([*base[30:90], "x", *words(rows[3][1])]), "en", "x"), (160, " ".join(words(rows[110][1])[5:]), "en", "x"), (170, " ".join(base[:70]), "en", "x")]
    named = [r for r in more if r[0] is not None]
    want = without_repeats(named)
    index, found = str(tmp_path / "index"), Counter()
    for low, high in ((0, 60), (60, 120), (120, 1000)):
        part = table(spark, [r for r in named if low <= r[0] < high])
        if low == 60:
            with monkeypatch.context() as m:
                m.setattr(substring, "_verify", lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    substring.substring_dedup(part, index=index)
        found += got(substring.substring_dedup(part, 2, with_text=True, index=index), *CUT)
    assert found == want
    with pytest.raises(ValueError, match="not after"):
        substring.substring_dedup(table(spark, rows[:3]), index=index)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tributary_run_")]
    runs = [p.name for p in (tmp_path / "index").iterdir() if p.name.startswith("tributary_run_")]
    assert 1 <= len(runs) <= 2 and not [p for p in Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")).iterdir() if p.name.startswith("tributary_run_")]


def test_claims():
    """They are spans, or joins of spans, that cover all words that spans cover, none more than twice."""
    of = lambda *spans: list(substring.claims(*np.array(spans, np.int64).T))
    assert of((1, 0, 5, 10, 1), (1, 0, 6, 11, 1), (1, 0, 6, 11, 3), (2, 0, 9, 14, 1), (1, 0, 20, 25, 2)) == [(1, 0, 5, 10, 4), (1, 0, 20, 25, 2)]
    long = of((1, 0, 1_000, 3, 3_000))
    assert sum(n for *_, n in long) == 3_000 and [w for _, _, w, _, _ in long] == [1_000, 1_024, 2_048, 3_072]
    rng = random.Random(16)
    for _ in range(500):
        spans = [(rng.randint(0, 2), 0, p + rng.choice([0, 7]), p, rng.randint(1, 9)) for p in (rng.randint(0, 300) for _ in range(rng.randint(1, 40)))]
        single = {(w, q + k, p + k) for w, _, q, p, n in spans for k in range(n)}
        found = of(*spans)
        assert {(w, q + k, p + k) for w, _, q, p, n in found for k in range(n)} <= single
        count = Counter(x for *_, p, n in found for x in range(p, p + n + 49))
        assert set(count) == {x for *_, p, n in spans for x in range(p, p + n + 49)} and max(count.values()) <= 2


def test_language(spark):
    rng = random.Random(8)
    letters = {"aa": "aeioubcd", "bb": "xyzwvkqj", "cc": "éèàùçñöü"}
    text = lambda s: " ".join("".join(rng.choice(s) for _ in range(5)) for _ in range(40))
    rows = [(k, text(letters[lang]), lang, "x") for k, lang in enumerate(["aa", "bb", "cc"] * 40)]
    odd = [(500, None, "aa", "x"), (501, "", None, "x"), (502, "12 34 !?", "bb", "x"), (None, text(letters["aa"]), None, None), (503, text(letters["bb"]).upper(), None, "x"), (504, (text(letters["cc"]) + " ") * 300, None, "x")]
    out = language.identify(table(spark, [*rows, *odd])).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == lang and 0 < by[i]["score"] <= 1 for i, _, lang, _ in rows)
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert (by[None]["lang_pred"], by[503]["lang_pred"], by[504]["lang_pred"]) == ("aa", "bb", "cc")
    nothing = language.identify(table(spark, [(i, t, None, s) for i, t, _, s in rows[:5]])).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert language.identify(table(spark, rows).limit(0)).count() == 0
    both = language.with_language(table(spark, [*rows, *odd]))
    assert both.select("row.*").columns == table(spark, rows).columns and both.where("lang_pred = 'und' and not letters").count() == 3


def test_language_bundles():
    """Against the definition, letter by letter; also where a text is taken in pieces."""
    rng = random.Random(13)
    text = lambda n: " ".join("".join(rng.choice("abcéß") for _ in range(rng.randint(1, 6))) for _ in range(n))
    texts = [text(30), "", "12 !", "a", "Ab, c" + " 3 " + text(5), text(400)]
    space, plain = language.Space(), []
    for t in texts:
        letters, sums = [], np.zeros(space.dimension)
        for c in " " + t.lower() + " ":
            c = ord(c) if c.isalpha() else 0
            if c or not letters or letters[-1]:
                letters.append(c)
        if len(letters) > 1:
            for k in range(len(letters) - 2):
                # the last letter of a gram is not permuted, each one before it by one place more
                sums += space.vector(letters[k + 2]).astype(int) * np.roll(space.vector(letters[k + 1]), 1) * np.roll(space.vector(letters[k]), 2)
        plain.append(sums)
    assert np.array_equal(space.bundles(texts), np.array(plain, np.float32))
    whole = language.PIECE
    try:
        language.PIECE = 17
        assert np.array_equal(space.bundles(texts), np.array(plain, np.float32))
    finally:
        language.PIECE = whole


def test_language_learns_rare_ones(spark):
    """Beside a hot language and many labelled rows without words, the few rows of a rare one are learnt from."""
    rng = random.Random(11)
    text = lambda s: " ".join("".join(rng.choice(s) for _ in range(5)) for _ in range(12))
    rows = [(k, text("aeioubcd"), "hot", "x") for k in range(3_000)] + [(5_000 + k, text("xyzwvkqj"), "rare", "x") for k in range(3)]
    rows += [(10_000 + k, (None, "", "12 ?!")[k % 3], ("rare", "hot", "none")[k // 3 % 3], "x") for k in range(3_000)]
    df = table(spark, rows)
    found = language.learn(df, sample_rows=20)
    assert set(found) == {"hot", "rare"}
    out = language.identify(df, found).collect()
    assert all(r["lang_pred"] == ("hot" if r["doc_id"] < 5_000 else "rare") for r in out if r["doc_id"] < 10_000)
    same = language.learn(table(spark, [(None, *r[1:]) for r in rows]), sample_rows=20)  # no doc_id to tell rows apart
    assert set(same) == {"hot", "rare"}


def test_language_shares():
    share = language.shares({"a": 10, "b": 1_000, "c": 10_000_000}, 2_010, least=64)
    assert share == {"a": 1, "b": 1, "c": 1_000 / 10_000_000}
    assert language.shares({"a": 10, "b": 10}, 20) == {"a": 1, "b": 1} and language.shares({}, 5) == {}
    assert language.shares({"a": 10_000_000, "b": 300}, 10) == {"a": 64 / 10_000_000, "b": 64 / 300}


def test_licenses(spark):
    rng = random.Random(9)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(n))
    long = licenses.TEMPLATES["mit-permission"].split()
    cut = " ".join(w for k, w in enumerate(long) if k != 40)  # one word is missing
    rows = [
        (1, f"{filler(500)}\n{licenses.TEMPLATES['mit'].upper()}\n{filler(33)}", {"mit"}), (2, f"{filler(77)} // {cut} {filler(10)}", {"mit-permission"}), (3, filler(300), set()), (4, None, set()), (5, "", set()),
        (6, licenses.TEMPLATES["gpl-3.0"], {"gpl-3.0"}), (7, f"{filler(5000)} {licenses.TEMPLATES['apache-2.0']} {filler(3)} {licenses.TEMPLATES['cc-by-nc-4.0']}", {"apache-2.0", "cc-by-nc-4.0"}), (8, " ".join(long[: len(long) // 2]), set()),
    ]
    df = table(spark, [(i, t, None, None) for i, t, _ in rows] + [(1, rows[0][1], None, None)])
    out = licenses.license_scan(df).collect()
    assert len(out) == 9 and all(set(filter(None, r["licenses"].split(","))) == dict((i, s) for i, _, s in rows)[r["doc_id"]] and r["n_licenses"] == len(set(filter(None, r["licenses"].split(",")))) for r in out)
    assert {r["containment"] for r in out if r["doc_id"] in (3, 4, 5, 8)} == {0.0}
    every = {k: f"{filler(20)} {v} {filler(20)}" for k, v in licenses.TEMPLATES.items()}
    found = licenses.license_scan(table(spark, [(k, t, None, None) for k, t in enumerate(every.values())])).collect()
    assert all(name in r["licenses"].split(",") for r in found for k, name in enumerate(every) if k == r["doc_id"])
    with pytest.raises(ValueError):
        licenses.scan(df, {"short": "All rights reserved."})
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_license_texts(spark):
    """Whole texts, and their terms amid other words or with some changed, are known from each other."""
    rng = random.Random(10)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(n))
    names = [f"{x}-text" for x in ("apache-2.0", "artistic", "cc0-1.0", "gpl-2.0", "gpl-3.0", "isc", "lgpl-2.1", "lgpl-3.0", "mpl-1.1", "mpl-2.0", "unlicense", "bsl-1.0", "zlib")]
    texts = {}
    for k, name in enumerate(names):
        w = licenses.TEMPLATES[name].split()
        texts[k] = " ".join(w)
        texts[100 + k] = f"{filler(700)} {' '.join(x for i, x in enumerate(w) if i % 60 != 50)} {filler(9000)}"
        texts[200 + k] = " ".join(w[: len(w) // 2])
    out = {r["doc_id"]: r for r in licenses.license_scan(table(spark, [(i, t, None, None) for i, t in texts.items()])).collect()}
    for k, name in enumerate(names):
        assert out[k]["licenses"] == out[100 + k]["licenses"] == name and out[k]["containment"] == 1, name
        assert name not in out[200 + k]["licenses"]


def shingles(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]


def test_licenses_by_brute_force(spark):
    """Each window's share of each template, counted out: what is reported is exact, and of what holds 0.8 hardly any is missed."""
    rng = random.Random(17)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(n))
    names = ["mit-permission", "gpl-header", "apache-2.0-header", "isc-text", "unlicense-text", "mit", "cc-by-4.0", "bsd-redistribution"]
    texts = {}
    for k in range(240):
        w = licenses.TEMPLATES[names[k % len(names)]].split()
        change = rng.choice([0, 0.01, 0.02, 0.04, 0.08])
        texts[k] = f"{filler(rng.randint(0, 300))} {' '.join(x if rng.random() >= change else 'zz' for x in w)} {filler(rng.randint(0, 300))}"
    want = {}
    for k, text in texts.items():
        own = shingles(text)
        for name, template in licenses.TEMPLATES.items():
            parts = shingles(template)
            m = 1
            while m < len(parts):
                m *= 2
            best = max((len(set(parts) & set(own[at : at + 2 * m])) / len(set(parts)) for at in range(0, max(1, len(own)), m)), default=0)
            if best >= 0.8:
                want[k, name] = best
    _, found = licenses.scan(table(spark, [(k, t, None, None) for k, t in texts.items()]))
    got_ = {(r["doc_id"], r["template"]): r["containment"] for r in found.collect()}
    assert all(abs(want[x] - c) < 1e-9 for x, c in got_.items())
    assert len(want) > 150 and len(got_) / len(want) >= 0.99
    with pytest.raises(ValueError, match="bytes"):
        licenses.scan(table(spark, []), {"huge": "word " * (1 << 20)})
