"""Ranked search against scoring of every document, block bounds, and how much the bounds save."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from conftest import SF01
from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import lexical

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("term", T.StringType())])
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by the formula, for every query and document."""
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 50 + ((50 * sum(c.values()) * n_docs) // n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(words(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def index_rows(builder, shard):
    out = {}
    for part in builder.rows(shard):
        for name, values in part.items():
            out.setdefault(name, []).extend(values)
    return out


def ran(spark, docs, items, k=50, **more):
    found = lexical.search(lexical.build(docs), spark.createDataFrame([(*x, "clash") for x in items], ITEMS), k, **more)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_awkward_rows(spark, documents, awkward):
    docs = awkward + [(11, "Word1 WORD1 ÀÉ àé x9 日本"), (12, "word1"), (13, "word1"), (14, "ÀÉ àÉ 日本語"), (15, "a" * 300 + " " + "b " * 70000)]
    items = [(1, "word1 word1 word2"), (2, None), (3, ""), (4, " .,; "), (5, "nowhere"), (None, "one a"), (6, "ÀÉ 日本"), (1, "b"), (7, "long x" * 3), (8, "a" * 300)]
    table = documents(docs).withColumnRenamed("lang", "term").withColumnRenamed("source", "shard")
    want = brute(docs, items, 50)
    assert ran(spark, table, items) == want
    assert ran(spark, table.repartition(3), items, query_bytes=10) == want  # several passes, several shards
    assert ran(spark, table, items, 1) == brute(docs, items, 1)
    assert ran(spark, documents([]), items) == [] and ran(spark, table, []) == []
    assert ran(spark, documents([(1, None), (2, "?!")]), items) == []


@pytest.mark.parametrize("k,window,block", [(50, 4096, 128), (3, 16, 4), (1, 7, 2)])
def test_many_ties_and_small_blocks(spark, documents, monkeypatch, k, window, block):
    rng = random.Random(k)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(500)]
    docs = [(rng.randrange(10**6), " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 3, 30, 600])))) for _ in range(400)]
    docs += [(i, docs[0][1]) for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 20])))) for i in range(12)]
    monkeypatch.setattr(lexical, "WINDOW", window)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "ROWS", 50)
    # in this process, as patched values do not reach the workers
    builders = [lexical.ShardBuilder() for _ in range(3)]
    for j, d in enumerate(docs):
        builders[j % 3].add(*d)
    rows = [index_rows(b, s) for s, b in enumerate(builders)]
    batches = [pa.RecordBatch.from_pydict(r, schema=lexical._arrow(lexical.INDEX)) for r in rows]
    df = Counter()
    for r in rows:
        df.update({t: n for t, n in zip(r["term"], r["df"]) if t is not None})
    n_docs, n_terms = sum(r["df"][0] for r in rows), sum(r["n_terms"][0] for r in rows)
    queries = [(i, sorted(set(words(t)))) for i, t in items]
    weights = {t: lexical.weight(df[t], n_docs) for _, ws in queries for t in ws if df[t]}
    kept = [pa.RecordBatch.from_pylist([r for r in b.to_pylist() if r["term"] is None or r["term"] in weights], schema=b.schema) for b in batches]
    (out,) = lexical._searching(queries, weights, n_docs, n_terms, k)(iter(kept))
    got = {}
    for r in out.to_pylist():
        got.setdefault(r["query"], []).append((-r["score"], r["doc_id"]))
    assert sorted((q, n + 1, i, -s) for q, v in got.items() for n, (s, i) in enumerate(sorted(v)[:k])) == sorted(brute(docs, items, k))


def test_bounds_hold_and_blocks_unpack(spark, documents):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["a", "b", "c", "d"], k=rng.choice([1, 5, 300, 2000])))) for i in range(1500)]
    builder = lexical.ShardBuilder()
    for d in docs:
        builder.add(*d)
    rows = index_rows(builder, 7)
    lengths = np.frombuffer(rows["lengths"][0], "<u4").astype(np.int64)
    ids = np.frombuffer(rows["doc_ids"][0], "<i8")
    assert (np.diff(lengths) >= 0).all()
    text = dict(docs)
    for j, term in enumerate(rows["term"][1:], 1):
        p = lexical.Postings({c: v[j] for c, v in rows.items()}, 3, lambda n: 50 + n)
        found, tfs = p.between(0, len(ids))
        assert {int(ids[d]): int(t) for d, t in zip(found, tfs)} == {i: c for i, t in text.items() if (c := t.split().count(term))}
        for b in range(len(p.first)):
            d, t = p.unpack(np.array([b]))
            assert (3 * lexical.gain(t, 50 + lengths[d]) <= p.bounds[b]).all() and d[0] == p.first[b] and d[-1] == p.last[b]


def test_bounds_save_work(spark):
    """On the given documents, many times over, many postings of the queries' terms are never scored."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()] * 12
    items = [r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").select("text").collect()]
    builder = lexical.ShardBuilder()
    for d in docs:
        builder.add(*d)
    rows = index_rows(builder, 0)
    at = {t: j for j, t in enumerate(rows["term"])}
    n_docs, n_terms = rows["df"][0], rows["n_terms"][0]
    measure = lambda n: 50 + 50 * n * n_docs // n_terms
    lengths = np.frombuffer(rows["lengths"][0], "<u4").astype(np.int64)
    scored = postings = 0
    for text in items:
        held = [t for t in set(words(text)) if t in at and lexical.weight(rows["df"][at[t]], n_docs) > 0]
        lists = [lexical.Postings({c: v[at[t]] for c, v in rows.items()}, lexical.weight(rows["df"][at[t]], n_docs), measure) for t in held]
        postings += sum(rows["df"][at[t]] for t in held)
        if lists:
            scored += lexical.search_shard(lists, measure(lengths), np.frombuffer(rows["doc_ids"][0], "<i8"), np.ones(len(lengths), bool), lexical.Best(50))
    assert 0 < scored < 0.75 * postings, (scored, postings)


def test_packed_numbers():
    values, wide = np.array([1, 300, 70000, 5, 255]), np.array([False, True, True, False, False])
    raw, ends = lexical._packed(values, wide)
    assert ends.tolist() == [1, 5, 9, 10, 11] and lexical._unpacked(raw[1:9], True).tolist() == [300, 70000]
    assert lexical._unpacked(raw[9:], False).tolist() == [5, 255] and len(lexical._packed(values[:0], wide[:0])[0]) == 0
