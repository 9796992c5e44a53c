"""The registered queries against their SQL, and the pipeline against its stages' definitions."""

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from conftest import SF001
from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import minhash, packing, pii, quality, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF001)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_stages(spark, documents, awkward):
    docs = documents(awkward + [(100 + i, f"mail me at joe.{i}@example.org " + " ".join(f"word{i}x{j}" for j in range(80)) + ".") for i in range(5)])
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, None)
        assert out.columns == docs.columns
        if name == "quality":
            want = {(r.doc_id, r.text_hash) for r in quality.judge(docs).where("kept").collect()}
            assert out.count() >= len(want) and {r.doc_id for r in out.collect()} == {d for d, _ in want}
        elif name == "near_duplicates":
            want = {r.doc_id for r in minhash.near_duplicates(docs).where("kept").collect()}
            assert {r.doc_id for r in out.collect()} == want
        else:
            model = pii.field()
            for r, s in zip(sorted(out.collect(), key=str), sorted(docs.collect(), key=str)):
                assert r.text == pii.mask(s.text, pii.all_spans([s.text], model)[0][1])
                assert r.n_chars == len(r.text)
            assert out.where("text like '%@example.org%'").count() == 0
        docs = spark.createDataFrame(out.collect(), out.schema)
    name, stage = corpus_pipeline.STAGES[-1]
    pieces = stage(spark, docs, None).collect()
    one = {r.doc_id: r.doc_tokens for r in packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert {r.doc_id: r.doc_tokens for r in pieces} == one
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), None).collect() == []


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF001).collect()
    tokens = {}
    for r in pieces:
        tokens.setdefault(r.doc_id, [r.doc_tokens, 0])[1] += r.length
    assert tokens and all(a == b for a, b in tokens.values())
