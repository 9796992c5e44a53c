"""Ranked lexical search: a sharded index of compressed posting blocks, searched by Block-Max MaxScore.

``build`` writes the index.  A shard is a run of documents of one task, numbered by
length, so that the documents of a block are alike.  A term's postings in a shard are
cut into blocks; a block's document numbers and frequencies are stored in the fewest
bytes that hold them, and beside them, readable without unpacking, its first and last
document, its largest frequency and its smallest document length.  As a posting's
score grows with the frequency and falls with the length, these two bound every score
in the block, whatever the collection's totals become when more shards are added.

``search`` sends the lists of the queries' terms to their shards.  Per shard, query and
window of documents, the lists are ordered by their global bounds, and those whose
bounds together stay below the score to beat are not essential: documents that hold
none of the other lists' terms cannot be among the best.  The essential lists give the
candidates.  The others are then asked, the strongest first: where a candidate's score
so far, the maximum of its block there and the bounds of the lists still to come do not
reach the score to beat, the candidate is rejected, and only blocks that still hold a
candidate are unpacked.  A task keeps the best k per query over all its shards; these
short lists are merged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import small_batches
from tidepool.session import materialize, ship_package

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 text in lower-case ASCII
BLOCK = 128  # postings
FIRST_WINDOW, WINDOW = 256, 4096  # documents looked at before the score to beat is taken anew; doubled from one to the other
SHARD_DOCS, SHARD_TERMS = 32_768, 2_000_000  # a shard ends at whichever comes first
ROWS = 16_384  # of the index, made at once
QUERY_BYTES = 16 << 20  # of query texts searched for in one pass over the shards

# One row per term and shard; the row without a term has the shard's documents.
INDEX = ("shard long, term string, df long, first binary, last binary, max_tf binary, min_n binary, wide binary, docs binary, tfs binary, "
         "n_terms long, doc_ids binary, has_id binary, lengths binary")
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of letters, digits and other characters beyond ASCII; only A-Z are lower-cased."""
    return TERM.findall((text or "").encode("utf-8").lower())


def _starts(sorted_codes: np.ndarray) -> np.ndarray:
    """Where runs of equal codes begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_codes[1:] != sorted_codes[:-1]])) if len(sorted_codes) else np.zeros(0, np.int64)


def _packed(values: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each value's bytes): four bytes, little-endian, where ``wide`` is set, else one."""
    ends = np.cumsum(np.where(wide, 4, 1))
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - np.where(wide, 4, 1)
    for k in range(4):
        of = slice(None) if k == 0 else wide
        out[begin[of] + k] = (values[of] >> (8 * k)) & 255
    return out, ends


def _unpacked(raw: np.ndarray, wide: bool) -> np.ndarray:
    return raw.view("<u4").astype(np.int64) if wide else raw.astype(np.int64)


class ShardBuilder:
    """Collects documents until the shard is full; ``rows`` gives its index rows, some at a time."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.lengths, self.codes, self.total = [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = terms(text)
        if found:
            number = self.vocabulary
            self.codes.append(np.array([number.setdefault(t, len(number)) for t in found], np.uint32))
            self.ids.append(doc_id)
            self.lengths.append(len(found))
            self.total += len(found)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.total >= SHARD_TERMS

    def rows(self, shard: int) -> Iterator[dict[str, list]]:
        lengths = np.array(self.lengths, np.int64)
        order = np.argsort(lengths, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = sorted(self.vocabulary)
        rank = np.empty(len(names), np.int64)
        rank[[self.vocabulary[t] for t in names]] = np.arange(len(names))
        # one sorted code per occurrence: term, then document
        codes = np.sort(rank[np.concatenate(self.codes)] << 32 | np.repeat(place, lengths))
        runs = _starts(codes)
        tf = np.diff(runs, append=len(codes))
        term, doc = codes[runs] >> 32, codes[runs] & 0xFFFFFFFF
        n = lengths[order][doc]
        lists = _starts(term)
        inside = np.arange(len(term)) - np.repeat(lists, np.diff(lists, append=len(term)))
        blocks = np.flatnonzero(inside % BLOCK == 0)
        sizes = np.diff(blocks, append=len(term))
        first, last = doc[blocks], doc[blocks + sizes - 1]
        max_tf, min_n = np.maximum.reduceat(tf, blocks), np.minimum.reduceat(n, blocks)
        wide_doc, wide_tf = last - first > 255, max_tf > 255
        docs, doc_ends = _packed(doc - np.repeat(first, sizes), np.repeat(wide_doc, sizes))
        tfs, tf_ends = _packed(tf, np.repeat(wide_tf, sizes))
        wide = (wide_doc + 2 * wide_tf).astype(np.uint8)
        of_block = [x.astype("<u4") for x in (first, last, max_tf, min_n)] + [wide]
        ends = np.append(lists[1:], len(term))
        block_at, block_to = np.searchsorted(blocks, lists), np.searchsorted(blocks, ends)
        doc_to, tf_to = doc_ends[ends - 1], tf_ends[ends - 1]
        doc_at, tf_at = np.append(0, doc_to[:-1]), np.append(0, tf_to[:-1])
        fields = _arrow(INDEX).names
        ids = [self.ids[i] for i in order.tolist()]
        head = [shard, None, len(ids), *[None] * 7, self.total, np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
                np.array([i is not None for i in ids], np.uint8).tobytes(), lengths[order].astype("<u4").tobytes()]
        yield {name: [value] for name, value in zip(fields, head)}
        for at in range(0, len(names), ROWS):
            of = slice(at, at + ROWS)
            cut = lambda x, a, b: [x[i:j].tobytes() for i, j in zip(a[of].tolist(), b[of].tolist())]  # noqa: E731, B023
            some = [t.decode("utf-8") for t in names[of]]
            yield dict(zip(fields, [[shard] * len(some), some, (ends - lists)[of].tolist(), *(cut(x, block_at, block_to) for x in of_block),
                                    cut(docs, doc_at, doc_to), cut(tfs, tf_at, tf_to), *([None] * len(some) for _ in range(4))]))


def _building(batches):
    schema, builder, shard = _arrow(INDEX), ShardBuilder(), TaskContext.get().partitionId() << 32

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) for f in schema], schema=schema)

    for part in batches:
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            builder.add(doc_id, text)
            if builder.full():
                yield from map(batch, builder.rows(shard))
                builder, shard = ShardBuilder(), shard + 1
    if builder.ids:
        yield from map(batch, builder.rows(shard))


def build(docs: DataFrame, name: str = "lexical-index") -> DataFrame:
    """Write the index of ``docs`` (doc_id, text; other columns are not read) under the shared folder and read it back.

    Documents without a term (null, empty, signs only) are left out; a null doc_id is kept;
    rows that repeat a doc_id are documents of their own; a text of any length is one document.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    return materialize(docs.select("doc_id", "text").mapInArrow(_building, INDEX), name)


def weight(df: int, n_docs: int) -> int:
    """A term's weight: ``floor(1000 ln((2N + 2) / (2 df + 1)))``."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf, m):
    """What one unit of weight adds for a term found ``tf`` times, by the document's length measure (whole numbers)."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Postings:
    """A term's list in one shard: bounds per block, and blocks unpacked on demand."""

    def __init__(self, row: dict, w: int, measure: Callable[[np.ndarray], np.ndarray]):
        u4 = lambda c: np.frombuffer(row[c], "<u4").astype(np.int64)
        self.first, self.last = u4("first"), u4("last")
        self.bounds = w * gain(u4("max_tf"), measure(u4("min_n")))
        self.bound = int(self.bounds.max())
        self.w, self.wide = w, np.frombuffer(row["wide"], np.uint8)
        self.docs, self.tfs = np.frombuffer(row["docs"], np.uint8), np.frombuffer(row["tfs"], np.uint8)
        sizes = np.full(len(self.first), BLOCK)
        sizes[-1] = row["df"] - BLOCK * (len(sizes) - 1)
        self.doc_ends = np.cumsum(np.where(self.wide & 1, 4, 1) * sizes)
        self.tf_ends = np.cumsum(np.where(self.wide & 2, 4, 1) * sizes)
        self.known: dict[int, tuple] = {}

    def _block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.known:
            d0, t0 = (self.doc_ends[b - 1], self.tf_ends[b - 1]) if b else (0, 0)
            self.known[b] = (_unpacked(self.docs[d0:self.doc_ends[b]], bool(self.wide[b] & 1)) + self.first[b],
                             _unpacked(self.tfs[t0:self.tf_ends[b]], bool(self.wide[b] & 2)))
        return self.known[b]

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of some blocks, in document order."""
        got = [self._block(b) for b in blocks.tolist()]
        if len(got) == 1:
            return got[0]
        return np.concatenate([d for d, _ in got]), np.concatenate([t for _, t in got])

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` on and before ``high``, and their frequencies."""
        blocks = np.arange(np.searchsorted(self.last, low), np.searchsorted(self.first, high))
        if not len(blocks):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, tfs = self.unpack(blocks)
        here = slice(*np.searchsorted(docs, (low, high)))
        return docs[here], tfs[here]


class Best:
    """The k best (score, doc_id) of a query so far; equal scores by ascending doc_id, null ones last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.has = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def to_beat(self) -> int:
        """A document with a lower score cannot be among the best."""
        return int(self.scores[-1]) if len(self.scores) >= self.k else 1

    def merge(self, scores: np.ndarray, ids: np.ndarray, has: np.ndarray) -> None:
        scores, ids, has = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.has, has)))
        order = np.lexsort((ids, ~has, -scores))[:self.k]
        self.scores, self.ids, self.has = scores[order], ids[order], has[order]


def search_shard(lists: list[Postings], measures: np.ndarray, ids: np.ndarray, has: np.ndarray, best: Best) -> int:
    """Block-Max MaxScore of one query over one shard into ``best``; returns how many postings were scored.

    ``measures`` has the length measure of each document of the shard.
    """
    lists = sorted(lists, key=lambda p: p.bound)
    below = np.cumsum([0, *(p.bound for p in lists)])  # bounds of the lists before each one together
    scored, high, window = 0, 0, min(FIRST_WINDOW, WINDOW)
    while high < len(measures):
        low, high = high, min(high + window, len(measures))
        window = min(2 * window, WINDOW)
        to_beat = best.to_beat
        if below[-1] < to_beat:
            break
        essential = int(np.searchsorted(below[1:], to_beat))  # the first lists together stay below the score to beat
        partial = np.zeros(high - low, np.int64)
        for p in lists[essential:]:
            docs, tfs = p.between(low, high)
            partial[docs - low] += p.w * gain(tfs, measures[docs])
            scored += len(docs)
        candidates = np.flatnonzero(partial + below[essential] >= to_beat)
        candidates = candidates[partial[candidates] > 0]
        total = partial[candidates]
        candidates += low
        for at in range(essential - 1, -1, -1):
            if len(total) > best.k:  # the k best so far will have at least what they have
                to_beat = max(to_beat, int(np.partition(total, -best.k)[-best.k]))
            p = lists[at]
            block = np.minimum(np.searchsorted(p.last, candidates), len(p.last) - 1)
            here = (p.first[block] <= candidates) & (candidates <= p.last[block])
            able = total + np.where(here, p.bounds[block], 0) + below[at] >= to_beat
            candidates, total, block, here = candidates[able], total[able], block[able], here[able]
            if here.any():
                docs, tfs = p.unpack(np.unique(block[here]))
                found = np.minimum(np.searchsorted(docs, candidates), len(docs) - 1)
                hit = docs[found] == candidates
                total[hit] += p.w * gain(tfs[found[hit]], measures[candidates[hit]])
                scored += int(hit.sum())
        good = total >= to_beat
        best.merge(total[good], ids[candidates[good]], has[candidates[good]])
    return scored


def _searching(queries: list[tuple[int, list[str]]], weights: dict[str, int], n_docs: int, n_terms: int, k: int):
    out_schema = _arrow("query long, doc_id long, score long")

    def measure(n: np.ndarray) -> np.ndarray:
        return 50 + 50 * n * n_docs // n_terms

    def run(batches):
        best = {q: Best(k) for q, _ in queries}

        def finish(rows: dict[str | None, dict]) -> None:
            head = rows.pop(None)
            measures = measure(np.frombuffer(head["lengths"], "<u4").astype(np.int64))
            ids, has = np.frombuffer(head["doc_ids"], "<i8"), np.frombuffer(head["has_id"], np.uint8).astype(bool)
            lists = {t: Postings(r, weights[t], measure) for t, r in rows.items() if weights[t] > 0}
            for q, words in queries:
                held = [lists[t] for t in words if t in lists]
                if held:
                    search_shard(held, measures, ids, has, best[q])

        shard, rows = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if rows:
                        finish(rows)
                    shard, rows = row["shard"], {}
                rows[row["term"]] = row
        if rows:
            finish(rows)
        columns = [[q for q, b in best.items() for _ in b.scores], [int(i) if h else None for b in best.values() for i, h in zip(b.ids, b.has)],
                   [int(s) for b in best.values() for s in b.scores]]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], schema=out_schema)

    return run


def _one_pass(index: DataFrame, totals: tuple[int, int], queries: list[tuple[int, list[str]]], k: int) -> DataFrame:
    spark: SparkSession = index.sparkSession
    wanted = sorted({t for _, words in queries for t in words})
    needed = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "term string"))  # at most QUERY_BYTES of texts
    lists = index.join(needed, "term", "left_semi")
    weights = {r["term"]: weight(r["df"], totals[0]) for r in lists.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # at most one a wanted term
    rows = lists.unionByName(index.where("term is null")).select(*[f.split(" ")[0] for f in INDEX.split(", ")])
    dealt = rows.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(_searching(queries, weights, *totals, k), "query long, doc_id long, score long")


def ranked(scored: DataFrame, key: str, k: int) -> DataFrame:
    """The k best rows per key of the tasks' short lists, with their rank; a partial limit per task comes before the shuffle."""
    order: list[Column | str] = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = 50, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of ``index`` for every row of ``queries`` (item_id, text; other columns are not read).

    Returns item_id, rank (from 1), doc_id and score (above 0), equal scores by ascending
    doc_id.  A query without terms (null, empty, signs only) or without a match gives no
    rows; rows that repeat an item_id are queries of their own; null item_ids stay null;
    an empty index or query table gives no rows.  Queries are searched for in passes of at
    most ``query_bytes`` of text (or one row).
    """
    spark = index.sparkSession
    ship_package(spark)
    small_batches(spark)
    heads = index.where("term is null")
    totals = heads.agg(F.sum("df"), F.sum("n_terms")).first()
    numbered = materialize(queries.select(F.monotonically_increasing_id().alias("query"), "item_id", "text",
                                          F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_size")), "queries")
    passes = -(-(numbered.agg(F.sum("_size")).first()[0] or 0) // query_bytes)
    out = spark.createDataFrame([], "query long, doc_id long, score long")
    if totals[0]:
        for at in range(passes):
            some = numbered.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == at).select("query", "text").collect()
            words = [(r["query"], sorted({t.decode("utf-8") for t in terms(r["text"])})) for r in some]
            words = [(q, w) for q, w in words if w]
            if words:
                out = out.unionByName(_one_pass(index, tuple(totals), words, k))
    best = ranked(out, "query", k)
    return best.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
