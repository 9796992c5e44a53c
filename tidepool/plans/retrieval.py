"""Retrieval over the ``documents`` knowledge base with ``benchmark`` items as the query table.

Registered queries and their DuckDB oracles for R1-R19 and S12.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.embed import with_hashed_embedding
from tidepool.functions.text import WS_CLASS, tokenize, tokenize_collapsed
from tidepool.operators import bm25, cells, chunking, fusion, vector
from tidepool.operators.search_index import SearchIndex, shortlisted
from tidepool.session import scratch_path, ship_package
from tidepool.sources.tables import driver_table, spread

TOP_K = 10
RERANK_K = 3


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(driver_table(spark, sf, "documents", "doc_id", "text"))


def query_table(spark: SparkSession, sf: str) -> DataFrame:
    return driver_table(spark, sf, "benchmark", "item_id", "text") \
        .withColumnRenamed("item_id", "query_id")


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk(documents(spark, sf))


_INDEXES: dict[tuple, SearchIndex] = {}


def corpus_index(spark: SparkSession, sf: str) -> SearchIndex:
    """The search index of ``documents``, written once per application and state of the table's files."""
    files = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf, *state)
    if key not in _INDEXES:
        index = SearchIndex(spark, scratch_path(spark, "search-index"))
        index.add(chunks(spark, sf))
        _INDEXES[key] = index
    return _INDEXES[key]


def tokenised(chunk_table: DataFrame) -> DataFrame:
    """Tokens are not stored: they are one split of the (already collapsed) chunk text, cheaper to redo than to read."""
    return chunk_table.withColumn("c_tokens", tokenize_collapsed(F.col("text")))


def query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    q = query_table(spark, sf).withColumn("q_tokens", tokenize(F.col("text")))
    return with_hashed_embedding(q, "q_tokens", "qvec")


class Retrieval:
    """The whole funnel for one corpus and query table: dense + BM25 -> RRF -> rerank, all from one written index."""

    def __init__(self, spark: SparkSession, sf: str, k: int = TOP_K, rerank_k: int = RERANK_K):
        self.index = corpus_index(spark, sf)
        self.cv = self.index.chunks()
        self.qv = query_vectors(spark, sf)
        self.k, self.rerank_k = k, rerank_k
        self._dense = self._keyword = None

    def dense(self) -> DataFrame:
        if self._dense is None:
            self._dense = self._keep(vector.exact_top_k(
                self.cv, self.qv, self.k, "cvec", keep=["chunk_id"], order_cols=["doc_id", "start"]), "dense")
        return self._dense

    def keyword(self) -> DataFrame:
        if self._keyword is None:
            self._keyword = self._keep(self.index.keyword_top_k(self.qv, self.k), "bm25")
        return self._keyword

    def _keep(self, shortlist: DataFrame, name: str) -> DataFrame:
        """A shortlist (at most queries x k rows) written once, so fusion, rerank
        and the stage counts reuse it instead of searching again."""
        from tidepool.session import materialize
        return materialize(shortlist, f"shortlist-{name}")

    def fused(self) -> DataFrame:
        return fusion.rrf(self.dense(), self.keyword(), top_k=self.k)

    def reranked(self, scorer=fusion.overlap_scorer) -> DataFrame:
        # only the winners are tokenised
        fused = shortlisted(self.fused(), self.qv.count() * self.k)
        cand = self.cv.select("chunk_id", "text", "cvec").join(fused, "chunk_id") \
            .withColumn("c_tokens", tokenize_collapsed(F.col("text"))) \
            .join(self.qv.select("query_id", "q_tokens", "qvec"), "query_id")
        return fusion.rerank(cand, self.rerank_k, scorer)


def q_index_add(spark, sf):
    """The chunk index built in two adds that overlap, and added to once more without effect."""
    index = SearchIndex(spark, scratch_path(spark, "index"))
    whole = chunks(spark, sf)
    english = driver_table(spark, sf, "documents", "doc_id", "lang").where("lang = 'en'").select("doc_id")
    index.add(whole.join(english, "doc_id", "left_semi").select(*whole.columns))
    index.add(whole)
    index.add(whole)
    return index.chunks().select(*whole.columns)


def q_index_build(spark, sf):
    """The whole index written anew; its totals."""
    index = SearchIndex(spark, scratch_path(spark, "index"))
    index.add(chunks(spark, sf))
    return index.totals()


def q_doc_concat(spark, sf):
    conv = driver_table(spark, sf, "conversations", "conv_id", "turn", "text")
    return chunking.concat_pages(conv, doc_col="conv_id", page_col="turn")


def q_page_chunks(spark, sf):
    """Sentence windows over a conversation's turns as pages, no conversation in one row."""
    conv = driver_table(spark, sf, "conversations", "conv_id", "turn", "text")
    return chunking.chunk_pages(conv, doc_col="conv_id", page_col="turn")


def q_sentences(spark, sf):
    return chunking.sentences(documents(spark, sf))


def q_chunks(spark, sf):
    return chunks(spark, sf)


def q_tokens(spark, sf):
    return bm25.postings(chunks(spark, sf), id_cols=("chunk_id",))


def q_bm25_stats(spark, sf):
    return corpus_index(spark, sf).vocabulary().select("token", "df_t", F.round("idf", 6).alias("idf"))


def bm25_hits(spark, sf, k=TOP_K):
    return corpus_index(spark, sf).keyword_top_k(query_table(spark, sf), k)


def q_bm25_topk(spark, sf):
    return bm25_hits(spark, sf).select("query_id", "chunk_id", "rank", F.round("score", 6).alias("score"))


def q_embed_hash(spark, sf):
    cv = corpus_index(spark, sf).chunks()
    return cv.select("chunk_id", F.posexplode("cvec").alias("dim", "value")) \
        .where(F.col("value") != 0).withColumn("value", F.round(F.col("value").cast("double"), 6))


def q_dense_topk(spark, sf):
    return Retrieval(spark, sf).dense().select("query_id", "chunk_id", "rank",
                                               F.round("score", 6).alias("score"))


def _embeddings(spark, sf):
    return spread(driver_table(spark, sf, "embeddings", "vec_id", "embedding", "label"))


def q_knn_topk(spark, sf):
    emb = _embeddings(spark, sf)
    cents = vector.centroids(emb, "label", "embedding")
    return vector.exact_top_k(emb, cents, TOP_K, "embedding", keep=["vec_id"], order_cols=["vec_id"]) \
        .select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def q_knn_cells(spark, sf):
    """R7 at its exact setting: the nearest vectors to each label's centroid, by cells."""
    emb = _embeddings(spark, sf)
    cents = vector.centroids(emb, "label", "embedding")
    return cells.top_k(emb, cents, TOP_K, "embedding", "vec_id").withColumn("distance", F.round("distance", 6))


PROBES = 40  # of 64 cells: the given vectors hardly cluster (32 find 0.89 of the neighbours at sf0.1, 48 find 0.98)


def q_knn_cells_recall(spark, sf):
    """R7 at five eighths of the cells: of every twentieth vector's ten nearest, how many are found (exact answer beside it)."""
    emb = _embeddings(spark, sf).where("embedding is not null")
    asked = emb.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("qvec"))
    exact = cells.top_k(emb, asked, TOP_K, "embedding", "vec_id")
    some = cells.top_k(emb, asked, TOP_K, "embedding", "vec_id", probes=PROBES).select("query_id", "vec_id", F.lit(1).alias("hit"))
    joined = exact.join(some, ["query_id", "vec_id"], "left")
    return joined.agg(F.count(F.lit(1)).alias("n_neighbours"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


def q_rrf(spark, sf):
    return Retrieval(spark, sf).fused().select("query_id", "chunk_id", "rank",
                                               F.round("rrf_score", 6).alias("rrf_score"))


def q_rerank_topk(spark, sf):
    return Retrieval(spark, sf).reranked().select(
        "query_id", "chunk_id", "rerank_rank", F.round("rerank_score", 6).alias("rerank_score"))


def q_rerank_model(spark, sf):
    """R13 through the model hook: a numpy scorer asked in Arrow batches, set up once per worker."""
    ship_package(spark)
    return Retrieval(spark, sf).reranked(fusion.model_scorer(fusion.overlap_model)).select(
        "query_id", "chunk_id", "rerank_rank", F.round("rerank_score", 6).alias("rerank_score"))


def q_prompts(spark, sf):
    r = Retrieval(spark, sf)
    return fusion.prompts(r.reranked(), r.qv)


def q_retrieval_metrics(spark, sf):
    return fusion.metrics(Retrieval(spark, sf).reranked())


def q_low_precision(spark, sf):
    return fusion.low_precision(fusion.metrics(Retrieval(spark, sf).reranked()))


def q_stage_counts(spark, sf):
    r = Retrieval(spark, sf)
    stages = [("vector", r.dense()), ("bm25", r.keyword()), ("fused", r.fused()), ("reranked", r.reranked())]
    out = None
    for name, df in stages:
        c = df.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_candidates")) \
            .withColumn("stage", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


def q_preview(spark, sf):
    return fusion.preview(Retrieval(spark, sf).reranked())


QUERIES = {
    "embed_hash": q_embed_hash,
    "dense_topk": q_dense_topk,
    "knn_topk": q_knn_topk,
    "knn_cells": q_knn_cells,
    "knn_cells_recall": q_knn_cells_recall,
    "rrf": q_rrf,
    "rerank_topk": q_rerank_topk,
    "rerank_model": q_rerank_model,
    "prompts": q_prompts,
    "retrieval_metrics": q_retrieval_metrics,
    "low_precision": q_low_precision,
    "stage_counts": q_stage_counts,
    "preview": q_preview,
    "doc_concat": q_doc_concat,
    "page_chunks": q_page_chunks,
    "sentences": q_sentences,
    "chunks": q_chunks,
    "index_add": q_index_add,
    "index_build": q_index_build,
    "tokens": q_tokens,
    "bm25_stats": q_bm25_stats,
    "bm25_topk": q_bm25_topk,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_CHUNKS = rf"""
clean AS (
  SELECT doc_id, regexp_replace(regexp_replace(text, '{WS_CLASS}+', ' ', 'g'), '^ | $', '', 'g') AS c
  FROM documents),
sents AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(c, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)),
                             lambda s: s <> '') AS s FROM clean),
starts AS (
  SELECT doc_id, s, unnest(CASE WHEN len(s) > 0 THEN
           generate_series(0, CAST(ceil(greatest(len(s) - 5, 0) / 4.0) AS BIGINT) * 4, 4)
         ELSE [] END) AS start FROM sents),
chunks AS (
  SELECT printf('%s_chunk_%04d', CAST(doc_id AS VARCHAR), start) AS chunk_id, doc_id,
         CAST(start AS INTEGER) AS start, array_to_string(list_slice(s, start + 1, start + 5), ' ') AS text
  FROM starts),
ctoks AS MATERIALIZED (SELECT chunk_id, doc_id, start, list_filter(string_split(lower(text), ' '), lambda t: t <> '') AS t
          FROM chunks),
post AS MATERIALIZED (
  SELECT chunk_id, doc_id, start, CAST(len(t) AS INTEGER) AS dl, tok AS token, count(*) AS tf
  FROM (SELECT chunk_id, doc_id, start, t, unnest(t) AS tok FROM ctoks) x
  GROUP BY chunk_id, doc_id, start, dl, token),
stats AS (SELECT count(*) AS n_docs, sum(len(t)) / count(*) AS avgdl FROM ctoks),
frequencies AS (SELECT token, count(*) AS df_t FROM post GROUP BY token),
vocab0 AS MATERIALIZED (
  SELECT token, df_t, ln(n_docs - df_t + 0.5) - ln(df_t + 0.5) AS idf_raw FROM frequencies, stats),
means AS (SELECT avg(idf_raw) AS mean_idf FROM vocab0),
vocab AS (
  SELECT token, df_t, idf_raw, CASE WHEN idf_raw < 0 THEN mean_idf * 0.25 ELSE idf_raw END AS idf
  FROM vocab0, means),
queries AS (SELECT item_id AS query_id, text FROM benchmark),
qtok AS (
  SELECT query_id, tok AS token, count(*) AS qtf FROM (
    SELECT query_id, unnest(list_filter(string_split(
      regexp_replace(regexp_replace(lower(text), '{WS_CLASS}+', ' ', 'g'), '^ | $', '', 'g'), ' '),
      lambda t: t <> '')) AS tok FROM queries) q
  GROUP BY query_id, token),
scored AS (
  SELECT q.query_id, p.chunk_id, p.doc_id, p.start,
         sum(CAST(floor(q.qtf * v.idf * (CAST(p.tf AS DOUBLE) * 2.5 /
              (p.tf + 1.5 * (0.25 + 0.75 * p.dl / (SELECT avgdl FROM stats)))) * 1e12) AS BIGINT)) / 1e12 AS score
  FROM qtok q JOIN vocab v ON q.token = v.token JOIN post p ON p.token = q.token
  GROUP BY q.query_id, p.chunk_id, p.doc_id, p.start),
firstk AS (SELECT chunk_id, doc_id, start FROM chunks ORDER BY doc_id, start LIMIT {TOP_K}),
cand AS (
  SELECT * FROM scored
  UNION ALL
  SELECT q.query_id, f.chunk_id, f.doc_id, f.start, 0.0 AS score
  FROM queries q, firstk f
  WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.query_id = q.query_id AND s.chunk_id = f.chunk_id)),
bm25 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, start) AS rank FROM cand)
  WHERE rank <= {TOP_K})
"""

_HEX = "'0123456789abcdef'"


def _bucket(x: str) -> str:
    h = f"sha256({x})"
    return (f"(((strpos({_HEX}, substr({h}, 7, 1)) - 1) * 16 + strpos({_HEX}, substr({h}, 8, 1)) - 1) % 64)")


_DENSE = rf"""
cb AS (
  SELECT chunk_id, b, count(*) AS cnt
  FROM (SELECT chunk_id, unnest(list_transform(t, lambda x: {_bucket('x')})) AS b FROM ctoks) x
  GROUP BY chunk_id, b),
cvec AS (SELECT chunk_id, b, CAST(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY chunk_id)) AS FLOAT) AS v FROM cb),
qt AS (
  SELECT query_id, text, list_filter(string_split(
    regexp_replace(regexp_replace(lower(text), '{WS_CLASS}+', ' ', 'g'), '^ | $', '', 'g'), ' '),
    lambda t: t <> '') AS t FROM queries),
qb AS (
  SELECT query_id, b, count(*) AS cnt
  FROM (SELECT query_id, unnest(list_transform(t, lambda x: {_bucket('x')})) AS b FROM qt) x
  GROUP BY query_id, b),
qvec AS (SELECT query_id, b, CAST(cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY query_id)) AS FLOAT) AS v FROM qb),
dots AS (
  SELECT q.query_id, c.chunk_id, sum(CAST(q.v AS DOUBLE) * CAST(c.v AS DOUBLE)) AS score
  FROM qvec q JOIN cvec c ON q.b = c.b GROUP BY q.query_id, c.chunk_id),
dense AS (
  SELECT * FROM (
    SELECT q.query_id, ch.chunk_id, ch.doc_id, ch.start, coalesce(d.score, 0.0) AS score,
           row_number() OVER (PARTITION BY q.query_id
                              ORDER BY round(coalesce(d.score, 0.0), 9) DESC, ch.doc_id, ch.start) AS rank
    FROM queries q CROSS JOIN chunks ch
    LEFT JOIN dots d ON d.query_id = q.query_id AND d.chunk_id = ch.chunk_id)
  WHERE rank <= {TOP_K}),
fused AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, seen) AS rank FROM (
      SELECT query_id, chunk_id, doc_id, start,
             coalesce(CAST(1 AS DOUBLE) / (60 + min(v_rank)), 0.0)
               + coalesce(CAST(1 AS DOUBLE) / (60 + min(b_rank)), 0.0) AS rrf_score,
             coalesce(min(v_rank), 1000000 + min(b_rank)) AS seen
      FROM (SELECT query_id, chunk_id, doc_id, start, rank AS v_rank, CAST(NULL AS BIGINT) AS b_rank FROM dense
            UNION ALL
            SELECT query_id, chunk_id, doc_id, start, CAST(NULL AS BIGINT), rank FROM bm25) u
      GROUP BY query_id, chunk_id, doc_id, start) g)
  WHERE rank <= {TOP_K}),
rcand AS (
  SELECT f.query_id, f.chunk_id, f.rank, ch.text, c.t AS c_tokens, q.t AS q_tokens,
         CASE WHEN len(list_distinct(q.t)) > 0 THEN
           CAST(len(list_filter(list_distinct(q.t), lambda x: list_contains(c.t, x))) AS DOUBLE)
             / len(list_distinct(q.t)) ELSE 0.0 END AS rerank_score
  FROM fused f JOIN chunks ch ON ch.chunk_id = f.chunk_id JOIN ctoks c ON c.chunk_id = f.chunk_id
  JOIN qt q ON q.query_id = f.query_id),
reranked AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS rerank_rank FROM rcand)
  WHERE rerank_rank <= {RERANK_K}),
sims AS (
  SELECT r.query_id, r.chunk_id, coalesce(d.score, 0.0) AS sim
  FROM reranked r LEFT JOIN dots d ON d.query_id = r.query_id AND d.chunk_id = r.chunk_id),
metrics AS (
  SELECT query_id, round_even(count_if(sim > 0.3) / count(*), 3) AS context_precision,
         round_even(avg(sim), 3) AS avg_similarity, count(*) AS chunks_in_context
  FROM sims GROUP BY query_id)
"""

_R = "WITH " + _CHUNKS.strip() + "\n"
_RD = "WITH " + _CHUNKS.strip() + ",\n" + _DENSE.strip() + "\n"

_PROMPT_HEAD_SQL = fusion.PROMPT_HEAD.replace("'", "''").replace("\n", "' || chr(10) || '")

ORACLE = {
    "embed_hash": _RD + "SELECT chunk_id, CAST(b AS INTEGER) AS dim, round(CAST(v AS DOUBLE), 6) AS value FROM cvec",
    "dense_topk": _RD + "SELECT query_id, chunk_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM dense",
    "knn_topk": """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent0 AS (SELECT label, i, sum(CAST(v AS DOUBLE)) AS s FROM e GROUP BY label, i),
cent AS (SELECT label, i, s / sqrt(sum(s * s) OVER (PARTITION BY label)) AS c FROM cent0),
dots AS (SELECT c.label AS query_id, e.vec_id, sum(c.c * CAST(e.v AS DOUBLE)) AS score
         FROM cent c JOIN e ON c.i = e.i GROUP BY c.label, e.vec_id)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM dots)
WHERE rank <= 10""",
    "knn_cells": """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent0 AS (SELECT label, i, sum(CAST(v AS DOUBLE)) AS s FROM e GROUP BY label, i),
cent AS (SELECT label, i, s / sqrt(sum(s * s) OVER (PARTITION BY label)) AS c FROM cent0),
away AS (SELECT c.label AS query_id, e.vec_id, round(sqrt(sum((c.c - CAST(e.v AS DOUBLE)) ** 2)), 9) AS d
         FROM cent c JOIN e ON c.i = e.i GROUP BY c.label, e.vec_id)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM away)
WHERE rank <= 10""",
    "knn_cells_recall": """
SELECT sum(least(10, n))::BIGINT AS n_neighbours, true AS recall_reached
FROM embeddings, (SELECT count(*) AS n FROM embeddings WHERE embedding IS NOT NULL) WHERE vec_id % 20 = 0 AND embedding IS NOT NULL""",
    "rrf": _RD + "SELECT query_id, chunk_id, CAST(rank AS INTEGER) AS rank, round(rrf_score, 6) AS rrf_score FROM fused",
    "rerank_topk": _RD + """SELECT query_id, chunk_id, CAST(rerank_rank AS INTEGER) AS rerank_rank,
  round(rerank_score, 6) AS rerank_score FROM reranked""",
    "prompts": _RD + """SELECT r.query_id, '""" + _PROMPT_HEAD_SQL + """' ||
  string_agg('[Source ' || CAST(rerank_rank AS VARCHAR) || ']: ' || r.text, chr(10) || chr(10) ORDER BY rerank_rank)
  || chr(10) || chr(10) || 'QUESTION: ' || any_value(q.text) || chr(10) || chr(10) || 'ANSWER:' AS prompt
FROM reranked r JOIN queries q ON q.query_id = r.query_id GROUP BY r.query_id""",
    "retrieval_metrics": _RD + "SELECT * FROM metrics",
    "low_precision": _RD + "SELECT query_id, context_precision, context_precision < 0.5 AS low_precision FROM metrics",
    "stage_counts": _RD + """
SELECT query_id, 'vector' AS stage, count(*) AS n_candidates FROM dense GROUP BY query_id UNION ALL
SELECT query_id, 'bm25', count(*) FROM bm25 GROUP BY query_id UNION ALL
SELECT query_id, 'fused', count(*) FROM fused GROUP BY query_id UNION ALL
SELECT query_id, 'reranked', count(*) FROM reranked GROUP BY query_id""",
    "preview": _RD + """SELECT query_id, CAST(rerank_rank AS INTEGER) AS source_no,
  substring(text, 1, 120) AS preview FROM reranked""",
    "doc_concat": """
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) || chr(10) AS text,
       CAST(count(*) AS BIGINT) AS n_pages,
       CAST(length(string_agg(coalesce(text, ''), chr(10) ORDER BY turn) || chr(10)) AS BIGINT) AS n_chars
FROM conversations GROUP BY conv_id""",
    "page_chunks": f"""
WITH whole AS (SELECT conv_id AS doc_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id),
{_CHUNKS.split("ctoks AS")[0].replace("FROM documents", "FROM whole").strip().rstrip(",")}
SELECT chunk_id, doc_id, start, text FROM chunks""",
    "sentences": _R + """SELECT doc_id, CAST(i - 1 AS INTEGER) AS sent_no, s[i] AS sentence
FROM (SELECT doc_id, s, generate_subscripts(s, 1) AS i FROM sents)""",
    "chunks": _R + "SELECT chunk_id, doc_id, start, text FROM chunks",
    "tokens": _R + "SELECT chunk_id, dl, token, tf FROM post",
    "bm25_stats": _R + "SELECT token, df_t, round(idf, 6) AS idf FROM vocab",
    "bm25_topk": _R + "SELECT query_id, chunk_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM bm25",
}
ORACLE["index_add"] = ORACLE["chunks"]
ORACLE["index_build"] = _R + "SELECT n_docs, sum(len(t))::BIGINT AS n_tokens, round(any_value(mean_idf), 6) AS mean_idf FROM ctoks, stats, means GROUP BY n_docs"
ORACLE["rerank_model"] = ORACLE["rerank_topk"]
