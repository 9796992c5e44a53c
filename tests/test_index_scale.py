"""What the index and its searches may write, move and compute, whatever the size of the tables."""

import hashlib
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.functions.embed import token_buckets
from tidepool.operators import vector
from tidepool.operators.search_index import SearchIndex, packed, unpacked

CHUNKS = "chunk_id string, doc_id long, start int, text string"


@pytest.fixture()
def index(spark, tmp_path):
    """An index whose chunks came in many more partitions than it writes files."""
    many = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        index = SearchIndex(spark, str(tmp_path / "index"))
        index.add(spark.createDataFrame([(f"c{i}", i // 2, i % 2, f"red w{i} w{i % 9} fish") for i in range(3000)], CHUNKS))
        yield index
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_files_follow_cores_not_partitions(spark, index):
    """For each file a process is started that counts the executor's memory a second time."""
    for table in ("chunks", "segments", "frequencies"):
        written = [f for f in os.listdir(f"{index.path}/{table}/0") if f.endswith(".parquet")]
        assert 1 <= len(written) <= 16 * spark.sparkContext.defaultParallelism, (table, len(written))
    assert index.chunks().count() == 3000 and index.chunks().select("chunk_id").distinct().count() == 3000
    assert len({r.segment for r in index._read("segments").collect()}) == index._read("segments").count()
    assert {r.token: r.df_t for r in index.vocabulary().collect()} == {"red": 3000, "fish": 3000} | {f"w{i}": 1 for i in range(9, 3000)} | {f"w{i}": len(range(i, 3000, 9)) for i in range(9)}


def test_search_does_not_shuffle_the_chunks(spark, index):
    """A shortlist is sent to the chunks, and a pass's tokens to the vocabulary."""
    hits = index.keyword_top_k(spark.createDataFrame([(1, "w1999 red"), (2, None)], "query_id long, text string"), 3)
    assert [r.chunk_id for r in hits.where("query_id = 1").orderBy("rank").collect()] == ["c1999", "c0", "c1"]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_postings_pass_the_jvm_packed(index):
    """binary cells, not arrays that are copied number by number; the numbers come back."""
    types = dict(index._read("segments").dtypes)
    assert (types["number"], types["tf"]) == ("binary", "binary")
    number, tf = np.array([5, 8191, 0, 1, 8190, 8191, 3]), np.array([1, 2, 70000, 1, 1, 3, 1])
    a, b = unpacked(*(pa.scalar(x, pa.binary()) for x in packed(number, tf)))
    assert a.tolist() == number.tolist() and b.tolist() == tf.tolist()
    assert [x.tolist() for x in unpacked(pa.scalar(b"", pa.binary()), pa.scalar(b"", pa.binary()))] == [[], []]


def test_token_buckets_are_those_of_the_hex_digits():
    words = ["red", "ñandú", "", "x" * 300, "İstanbul"]
    for dim in (64, 60):
        assert token_buckets(pa.array(words), dim).tolist() == [int(hashlib.sha256(w.encode()).hexdigest()[:8], 16) % dim for w in words]


def test_later_batches_are_ranked_only_where_they_can_enter(spark, monkeypatch):
    """once a query has its k best, only scores that reach the worst of them are ranked; the result is that of all pairs."""
    rng = np.random.default_rng(5)
    items = np.round(rng.normal(size=(4000, 4)), 1)
    queries = rng.normal(size=(30, 4))
    ranked = []
    found = vector._block_candidates
    monkeypatch.setattr(vector, "_block_candidates", lambda s, r, k: ranked.append(len(s)) or found(s, r, k))
    schema = spark.createDataFrame([], "query_id long, item_id long, score double").schema
    run = vector._local_top_k(type("Sent", (), {"value": (list(range(30)), queries)}), 5, "vec", ["item_id"], ["item_id"], schema)
    rows = [(i, x) for i, x in enumerate(items.tolist())]
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in part]), pa.array([x for _, x in part] + [], pa.list_(pa.float64()))], ["item_id", "vec"]) for part in (rows[a:a + 500] for a in range(0, 4000, 500))]
    (out,) = run(iter(batches))
    key = np.round(items @ queries.T, vector.RANK_DECIMALS)
    want = {(q, int(i)) for q in range(30) for i in np.lexsort((np.arange(4000), -key[:, q]))[:5]}
    assert set(zip(out.column("query_id").to_pylist(), out.column("item_id").to_pylist())) == want
    assert len(ranked) < 8
    with pytest.raises(ValueError):
        vector._matrix(pa.array([[1.0, 2.0], [1.0]]))
