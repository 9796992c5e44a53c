"""Page concatenation, sentence split and overlapping sentence chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidepool.functions.ids import chunk_id
from tidepool.functions.text import sentence_split
from tidepool.session import materialize


def concat_pages(pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no",
                 text_col: str = "text") -> DataFrame:
    """One text per document: pages in order, null page -> "", "\\n" after each page.

    Output ``(doc_id, text, n_pages, n_chars)``.  One row per document is the
    result itself, so the group is bounded by the document it builds.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page_col).alias("p"),
                                                   F.coalesce(F.col(text_col), F.lit("")).alias("t"))))
    out = pages.groupBy(doc_col).agg(ordered.alias("_pages"))
    text = F.concat(F.array_join(F.transform("_pages", lambda s: s["t"]), "\n"), F.lit("\n"))
    return out.select(doc_col, text.alias("text"), F.size("_pages").cast("bigint").alias("n_pages"),
                      F.length(text).cast("bigint").alias("n_chars"))


def sentences(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sent_no, sentence)``, one row per sentence."""
    return docs.select(doc_col, F.posexplode(sentence_split(F.col(text_col))).alias("sent_no", "sentence"))


def chunk(docs: DataFrame, sentences_per_chunk: int = 5, overlap: int = 1,
          doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Overlapping sentence windows -> ``(chunk_id, doc_id, start, text)``.

    Window starts are ``0, step, 2*step, ...`` up to the first window that
    reaches the last sentence, i.e. ``ceil(max(n - size, 0) / step) * step``;
    an empty document gives no chunk.  Per-row array functions only: no
    shuffle, and a document never has to meet another.
    """
    size = sentences_per_chunk
    step = max(1, size - overlap)
    s = sentence_split(F.col(text_col))
    with_s = docs.select(doc_col, s.alias("_s")).withColumn("_n", F.size("_s"))
    last = (F.ceil(F.greatest(F.col("_n") - size, F.lit(0)) / F.lit(step)) * step).cast("int")
    starts = F.when(F.col("_n") > 0, F.sequence(F.lit(0), last, F.lit(step))) \
        .otherwise(F.array().cast("array<int>"))
    exploded = with_s.select(doc_col, "_s", F.explode(starts).alias("start"))
    return exploded.select(
        chunk_id(F.col(doc_col), F.col("start")).alias("chunk_id"),
        F.col(doc_col).alias("doc_id"),
        F.col("start"),
        F.array_join(F.slice("_s", F.col("start") + 1, size), " ").alias("text"))


ENDED = r"[.!?]$"  # a piece of text after which a sentence is over


def _numbered_pages(pages: DataFrame, blocks: int | None) -> DataFrame:
    """Pages ``(doc, pieces, block, place, first, n)``: the number of each page's first sentence in its document and the
    document's number of sentences.

    Pages are sorted into range blocks.  Within a block, a document's pages count the sentences that end on them; a
    document's blocks are then summed up over one row per block, so a window spans one block's pages, or one row for
    each block, but never all pages of a long document.
    """
    order = ["doc", "page", "text"]
    ranged = pages.repartitionByRange(*([blocks] if blocks else []), *order)
    cut = materialize(ranged.select("*", F.spark_partition_id().alias("block"), sentence_split("text").alias("pieces")), "page-blocks")
    k = F.size("pieces")
    over = (k - F.when((k > 0) & ~F.element_at("pieces", -1).rlike(ENDED), 1).otherwise(0)).cast("bigint")
    here = W.partitionBy("doc", "block").orderBy(F.col("page").asc_nulls_first(), "text")
    placed = (cut.select("doc", "block", "pieces", over.alias("over"), F.row_number().over(here).alias("place"),
                         F.coalesce(F.sum(over).over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("within")))
    reach = F.max(F.when(F.size("pieces") > 0, F.col("within") + F.size("pieces")))
    totals = placed.groupBy("doc", "block").agg(F.sum("over").alias("over"), reach.alias("reach"))
    chain = W.partitionBy("doc").orderBy("block")
    before = F.coalesce(F.sum("over").over(chain.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    chained = (totals.withColumn("before", before).withColumn("n", F.max(F.col("before") + F.col("reach")).over(W.partitionBy("doc")))
               .select(F.col("doc").alias("_doc"), F.col("block").alias("_block"), "before", "n"))
    same = placed["doc"].eqNullSafe(chained["_doc"]) & (placed["block"] == chained["_block"])
    return placed.join(chained, same).select("doc", "pieces", "block", "place", (F.col("before") + F.col("within")).alias("first"), "n")


def chunk_pages(pages: DataFrame, sentences_per_chunk: int = 5, overlap: int = 1, doc_col: str = "doc_id",
                page_col: str = "page_no", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """S12 with R3/R4: the chunks of ``chunk(concat_pages(pages))``, without ever holding a document in one row.

    A sentence may run over several pages.  A page is cut into pieces; a piece is the whole or a part of the sentence
    whose number is that of the sentences over before it.  Pieces are dealt by (document, window), and a window's
    pieces in order are its text, so one document of any length is spread over all tasks, and only one window (the
    output row) is ever gathered.  ``blocks``: number of page blocks (default: the session's shuffle partitions).

    Null texts are empty pages, pages of one number follow each other by text, null numbers come first; a null
    document is a document like any other, named ``null`` in its chunk_ids; a document without a sentence and an empty table
    give no chunk.  Other columns are not read.
    """
    size, step = sentences_per_chunk, max(1, sentences_per_chunk - overlap)
    named = pages.select(F.col(doc_col).alias("doc"), F.col(page_col).alias("page"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = (_numbered_pages(named, blocks).select("doc", "block", "place", "first", "n", F.posexplode("pieces").alias("i", "piece"))
              .withColumn("sentence", F.col("first") + F.col("i")))
    last = F.ceil(F.greatest(F.col("n") - size, F.lit(0)) / F.lit(step)) * step
    low = F.greatest(F.ceil((F.col("sentence") - size + 1) / F.lit(step)), F.lit(0)) * step
    high = F.least(F.floor(F.col("sentence") / F.lit(step)) * step, last)
    starts = F.when(low <= high, F.sequence(low, high, F.lit(step).cast("bigint")))
    windows = pieces.withColumn("start", F.explode(starts)).groupBy("doc", "start").agg(
        F.array_sort(F.collect_list(F.struct("sentence", "block", "place", "i", "piece"))).alias("held"))
    return windows.select(
        chunk_id(F.col("doc"), F.col("start").cast("int")).alias("chunk_id"),
        F.col("doc").alias("doc_id"),
        F.col("start").cast("int").alias("start"),
        F.array_join(F.transform("held", lambda x: x["piece"]), " ").alias("text"))
