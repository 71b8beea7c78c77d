"""Registered queries on the smallest tables: against SQL where there is any, otherwise against brute force; and the pipeline."""

import hashlib
import os
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_small import fingerprint, mix_by_hand, pii_base, union, union_top, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from tributary.llm.oracles import ORACLES  # noqa: E402
from tributary.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return f"{v:.9f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in found.fetchall())
    assert Counter(tuple(plain(x) for x in r) for r in df.select(*sorted(columns)).collect()) == want


def test_others(spark, duck):
    docs = duck.execute("select doc_id, text, lang from documents order by doc_id").fetchall()
    fps = {i: fingerprint(t) for i, t, _ in docs}
    ids = list(fps)
    up = union(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[ids[a]] ^ fps[ids[b]]).bit_count() <= 4])
    tops = [union_top(up, k) for k in range(len(ids))]
    least = {t: min(i for i, x in zip(ids, tops, strict=True) if x == t) for t in set(tops)}
    assert {tuple(r) for r in QUERIES["op8_simhash_near_dedup"](spark, SF).collect()} == {(i, f"{fps[i]:016x}", least[t]) for i, t in zip(ids, tops, strict=True)}

    for r in QUERIES["op10_pii"](spark, SF).collect():
        text = next(t for i, t, _ in docs if i == r["doc_id"])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in pii_base(text)).encode()).hexdigest()

    lang = {i: x for i, _, x in docs}
    held = [r for r in QUERIES["op2_language_id"](spark, SF).collect() if r["held_out"]]
    assert len(held) > 30 and np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in held]) >= 0.95

    shards = QUERIES["op9_shard"](spark, SF).collect()
    n = Counter(r["shard"] for r in shards)
    assert set(n) == set(range(40)) and max(n.values()) - min(n.values()) <= 1 and len({(r["shard"], r["slot"]) for r in shards}) == len(docs)

    licenses = {r["doc_id"]: r["licenses"] for r in QUERIES["op4_license_scan"](spark, SF).collect()}
    for line, name in (("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("GNU General Public License, version 3.", "gpl-3.0")):
        assert {i for i, t, _ in docs if line in t} == {i for i, x in licenses.items() if name in x.split(",")}


def test_pipeline(spark, tmp_path):
    """The stages' decisions, one after the other, by brute force."""
    own = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, "src1", 0), (9002, "12 34 !!", "en", "src1", 8), (9003, "", None, None, 0), (9004, "lonely words of no source", None, None, 25)], own.schema)
    own.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in own.unionByName(odd).collect()}

    docs = {i: d for i, d in docs.items() if d[0] and any(c.isalpha() for c in d[0])}
    first = {}
    for i in sorted(docs):
        first.setdefault(" ".join(words(docs[i][0])) if docs[i][0] == docs[i][0].strip() else docs[i][0], i)
    docs = {i: docs[i] for i in first.values()}
    ids = sorted(docs)
    fps = [fingerprint(docs[i][0]) for i in ids]
    up = union(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    docs = {ids[k]: docs[ids[k]] for k in range(len(ids)) if union_top(up, k) == k}
    copies = {i: len(x) for (i, _), x in zip(docs.items(), mix_by_hand([(i, t, s) for i, (t, s) in docs.items()], cut=False), strict=True)}
    reference, want = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), Counter()
    for i, (t, _) in docs.items():
        e = np.array(reference.encode(t, add_special_tokens=False).ids, "<u4")
        want[i, len(e), hashlib.sha256(e.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += copies[i]

    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(tuple(r) for r in out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == +want
    frame = own.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0, name
        assert stage(spark, frame, str(tmp_path)).columns == frame.columns
    twice = frame.where("doc_id < 5").unionByName(frame.where("doc_id < 5")).unionByName(odd.withColumn("doc_id", odd["doc_id"] * 0))
    kept = corpus_pipeline.drop_exact_copies(spark, twice, str(tmp_path))
    assert kept.count() == kept.select("text").distinct().count()


@pytest.mark.parametrize("lang", [None, "und"])
def test_pipeline_keeps_texts_whose_language_is_not_learnt(spark, lang):
    """Without any label, or with the label that stands for no language, only texts without letters go."""
    rows = [(k, f"clean words of number {k}", lang) for k in range(8)] + [(100, None, lang), (101, "", lang), (102, "12 34 !!", lang)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.identify_language(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == list(range(8))


def test_pipeline_leaves_other_columns_alone(spark):
    """Whatever columns documents have, with names that the stages use themselves among them, they come back as they were."""
    names = ["_th", "_TH2", "_copy", "_lang_pred", "_score", "a.b", "row", "Kept", "uid", "_id", "h", "size", "shard", "place", "part", "room", "drawn", "_none", "_name", "letters", "we`ird"]
    texts = ["one text of many words", "one text of many words", "another, of other words", None, "12", "third text of letters", ""]
    rows = [(k, t, "en", f"s{k % 2}", *[k * 100 + j for j in range(len(names))]) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n.replace('`', '``')}` long" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() and {tuple(r) for r in out.collect()} <= set(rows), name
    assert corpus_pipeline.encode(spark, docs, SF).count() == len(rows)
