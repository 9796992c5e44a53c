"""The search index: adds that change no old file or were cut short, and how much the range bounds save."""

import hashlib
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import bm25
from tidepool.operators.search_index import SearchIndex, TokenList, TopHits, search_segment
from tidepool.plans import retrieval

from conftest import SF01


def files(path):
    return {os.path.join(d, f): hashlib.md5(open(os.path.join(d, f), "rb").read()).hexdigest() for d, _, names in os.walk(path) for f in names}


CHUNKS = "chunk_id string, doc_id long, start int, text string"


def test_adds(spark, tmp_path):
    path = str(tmp_path / "index")
    index = SearchIndex(spark, path)
    queries = spark.createDataFrame([(7, "red fish"), (8, None), (9, "absent")], "query_id long, text string")
    assert index.keyword_top_k(queries).collect() == []
    first = spark.createDataFrame([("a", 1, 0, "red fish"), ("b", 2, 0, "blue fish"), ("c", 2, 4, "red bird red")], CHUNKS)
    assert index.add(first) == 3
    before = files(path)
    more = spark.createDataFrame([("c", 2, 4, "other words"), ("d", 3, 0, "red red fish"), ("e", 3, 4, "")], CHUNKS)
    # an add that stopped before its manifest row: nobody sees it
    more.write.parquet(f"{path}/chunks/1")
    assert index.chunks().count() == 3
    assert index.add(more) == 2 and index.add(more) == 0
    after = files(path)
    assert before.items() <= after.items()
    assert {r.chunk_id: r.text for r in index.chunks().collect()}["c"] == "red bird red"
    assert {r.token: r.df_t for r in index.vocabulary().collect()} == {"red": 3, "fish": 3, "blue": 1, "bird": 1}
    total = index.totals().first()
    assert (total.n_docs, total.n_tokens) == (5, 10)
    hits = defaultdict(list)
    for r in index.keyword_top_k(queries, 4).orderBy("rank").collect():
        hits[r.query_id].append(r.chunk_id)
    assert {q: len(x) for q, x in hits.items()} == {7: 4, 8: 4, 9: 4}
    assert set(hits[7][:2]) == {"a", "d"} and hits[8] == hits[9] == ["a", "b", "c", "d"]  # no match: the first chunks
    assert [len(index.keyword_top_k(queries.where("query_id = 7"), k).collect()) for k in (1, 10)] == [1, 5]


def test_empty_index(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "index"))
    assert index.add(spark.createDataFrame([], CHUNKS)) == 0
    assert index.keyword_top_k(spark.createDataFrame([(1, "x")], "query_id long, text string")).collect() == []
    assert index.chunks().count() == 0 and index.vocabulary().count() == 0


def segments(index, words):
    """Token lists of each segment, by token, and the segments' chunk places."""
    lists, heads, avgdl = defaultdict(dict), {}, index.totals().selectExpr("n_tokens / n_docs").first()[0]
    for r in index._read("heads").collect():
        heads[r.segment] = r
    for r in index._read("postings").where(F.col("token").isin(words)).collect():
        lists[r.segment][r.token] = TokenList(np.array(r.number), np.array(r.tf), np.array(r.dl), avgdl)
    return lists, heads


def test_few_contributions_are_computed(spark):
    """Of the contributions of all queries to all chunks a small part is computed, and the best are those of a full sum."""
    index, queries = retrieval.corpus_index(spark, SF01), retrieval.query_table(spark, SF01)
    idf = {r.token: r.idf for r in index.vocabulary().collect()}
    wanted = defaultdict(list)
    for r in bm25.query_tokens(queries).collect():
        if r.token in idf:
            wanted[r.query_id].append((r.token, r.qtf * idf[r.token]))
    lists, heads = segments(index, sorted({t for ws in wanted.values() for t, _ in ws}))
    computed = total = 0
    for words in wanted.values():
        top, every = TopHits(10), TopHits(10)
        for s, head in heads.items():
            held = [(lists[s][t], w) for t, w in words if t in lists[s]]
            doc_id, start = (np.zeros(8192, np.int64) for _ in "ab")
            doc_id[head.number], start[head.number] = head.doc_id, head.start
            computed += search_segment(held, doc_id, start, [], top)
            units, hit = np.zeros(8192, np.int64), np.zeros(8192, bool)
            for t, w in held:
                units[t.number] += np.floor(w * t.part * 1e12).astype(np.int64)
                hit[t.number] = True
                total += len(t.number)
            every.merge(units[hit], doc_id[hit], start[hit])
        assert (top.rows == every.rows).all()
    print(f"{computed} of {total} contributions")
    assert computed < 0.5 * total


@pytest.mark.parametrize("negative", [False, True])
def test_bounds_by_brute_force(negative):
    """Random lists with ties, weights below zero and forced chunks: the same hits as a full sum."""
    rng = np.random.default_rng(3 + negative)
    for _ in range(60):
        n = int(rng.integers(1, 3000))
        doc_id, start = np.repeat(np.arange(4096), 2)[rng.permutation(8192)], rng.integers(0, 9, 8192)
        words, units, hit = [], np.zeros(8192, np.int64), np.zeros(8192, bool)
        fillers = rng.choice(n, min(n, 3), replace=False).tolist()
        for _ in range(int(rng.integers(0, 6))):
            number = np.sort(rng.choice(n, int(rng.integers(1, n + 1)), replace=False))
            weight = float(rng.choice([0.5, 1.0, 4.0])) * (-1 if negative and rng.random() < 0.5 else 1)
            t = TokenList(number, rng.integers(1, 4, len(number)), rng.integers(4, 7, len(number)), 5.0)
            words.append((t, weight))
            units[number] += np.floor(weight * t.part * 1e12).astype(np.int64)
            hit[number] = True
        hit[fillers] = True
        top, every = TopHits(5), TopHits(5)
        search_segment(words, doc_id, start, fillers, top)
        every.merge(units[hit], doc_id[hit], start[hit])
        assert (top.rows == every.rows).all()


def test_segments_hold_all_postings_and_vectors(spark, tmp_path, monkeypatch):
    """One row per segment, ended early by long chunks, holds the postings and vectors that the column expressions give."""
    from tidepool.functions.embed import with_hashed_embedding
    from tidepool.functions.text import tokenize_collapsed
    monkeypatch.setattr("tidepool.operators.search_index.SEGMENT_POSTINGS", 40)
    texts = ["Red fish  red", "", None, "İstanbul ΣΑΣ ñandú", " outer blanks ", "fish " * 30] + [f"w{i} w{i % 7} Fish fish x{i}" for i in range(200)]
    rows = [(f"c{i}", i // 3, i % 3, t) for i, t in enumerate(texts)] + [("n", None, 0, "red no document")]
    chunks = spark.createDataFrame(rows, CHUNKS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        index = SearchIndex(spark, str(tmp_path / "index"))
        assert index.add(chunks) == len(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    segments = index._read("segments").collect()
    assert len(segments) > 1 and len({s.segment for s in segments}) == len(segments)
    assert sum(len(s.doc_id) for s in segments) == len(rows)
    tokens = chunks.withColumn("c_tokens", tokenize_collapsed(F.col("text")))
    place = {(h.segment, n): (d, s) for h in index._read("heads").collect() for n, d, s in zip(h.number, h.doc_id, h.start)}
    stored = sorted((*(-1 if x is None else x for x in place[p.segment, n]), dl, p.token, tf) for p in index._read("postings").collect() for n, tf, dl in zip(p.number, p.tf, p.dl))
    assert stored == sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.dl, r.token, r.tf) for r in bm25.postings(tokens).collect())
    vectors = {r.chunk_id: r.cvec for r in with_hashed_embedding(tokens, "c_tokens", "cvec").collect()}
    assert {r.chunk_id: r.cvec for r in index.chunks().collect()} == vectors


def test_neither_add_nor_search_shuffles_postings(spark, tmp_path, monkeypatch):
    """Segments are written from the chunks, and searched, without an exchange."""
    plans = []

    def kept(self, rows, table, gen, options=None, write=SearchIndex._write):
        plans.append((table, rows._jdf.queryExecution().executedPlan().toString()))
        write(self, rows, table, gen, *([options] if options else []))

    monkeypatch.setattr(SearchIndex, "_write", kept)
    index = SearchIndex(spark, str(tmp_path / "index"))
    index.add(spark.createDataFrame([(f"c{i}", i, 0, f"red w{i} fish") for i in range(50)], CHUNKS))
    postings = [p for t, p in plans if t in ("postings", "segments")]
    assert postings and not any("Exchange" in p for p in postings)
    hits = index.keyword_top_k(spark.createDataFrame([(1, "red w7")], "query_id long, text string"), 3)
    assert [r.chunk_id for r in hits.orderBy("rank").collect()] == ["c7", "c0", "c1"]
    assert "hashpartitioning(segment" not in hits._jdf.queryExecution().toString()
