"""Tokens and postings for BM25 keyword retrieval.

Okapi BM25 with k1 = 1.5, b = 0.75 and the epsilon floor: a token whose idf
is negative gets ``epsilon * mean idf`` (mean over the whole vocabulary).
``search_index`` stores the postings and answers queries from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import tokenize

# Okapi BM25 parameters.
K1 = 1.5
B = 0.75
EPSILON = 0.25


def _tokens(chunks: DataFrame, text_col: str, tokens_col: str):
    """Reuse a precomputed token column when the chunk table carries one."""
    return F.col(tokens_col) if tokens_col in chunks.columns else tokenize(F.col(text_col))


def postings(chunks: DataFrame, id_cols=("chunk_id", "doc_id", "start"), text_col: str = "text",
             tokens_col: str = "c_tokens") -> DataFrame:
    """``(*id_cols, dl, token, tf)``: one row per distinct token of a chunk.

    Term frequencies are counted inside each chunk row (sort the tokens, then
    measure the runs), so a chunk's postings never leave its partition: no
    shuffle here.
    """
    srt = chunks.select(*id_cols, F.array_sort(_tokens(chunks, text_col, tokens_col)).alias("_s")) \
        .withColumn("dl", F.size("_s"))
    n = F.col("dl")
    run_starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                          lambda i: (i <= n) & ((i == 1) | (F.try_element_at("_s", i) != F.try_element_at("_s", i - 1))))
    st = srt.withColumn("_st", run_starts)
    pairs = F.transform("_st", lambda x, j: F.struct(
        F.try_element_at("_s", x).alias("token"),
        (F.coalesce(F.try_element_at("_st", j + 2), n + 1) - x).cast("bigint").alias("tf")))
    return st.select(*id_cols, "dl", F.explode(pairs).alias("_p")).select(*id_cols, "dl", "_p.token", "_p.tf")


def query_tokens(queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """``(query_id, token, qtf)``: query tokens with repeat counts (repeats add up)."""
    return queries.select(id_col, F.explode(tokenize(F.col(text_col))).alias("token")) \
        .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("qtf"))
