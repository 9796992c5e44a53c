"""One written index that every search reads (S13, R9-R11): chunks with vectors, block-max postings, document frequencies.

An index is a folder of generations.  ``add`` writes what it gets as a new one (chunks
whose id is known are left out), then the generation's row in the manifest, which is
what readers go by: an add that was cut short is not seen, and is written over by the
next.  Files of older generations are never touched; frequencies and totals are sums
over generations.

Chunks are numbered in segments of at most ``SEGMENT``.  A segment is made by one task from
chunks that follow each other and is one row: the places and lengths of its chunks, its
tokens and their postings.  So postings are neither shuffled nor sorted beyond a segment,
and a search reads the rows where they lie.  A token's postings in a segment are cut
into ranges of ``RANGE`` chunk numbers, with the largest contribution in each.
``keyword_top_k`` takes a query's tokens from the strongest on.  Once those still to come
cannot lift a chunk to the k-th best score so far, which a task carries from segment to
segment, no new chunk is a candidate; a candidate that its range's largest contribution
and the tokens after cannot lift that far is dropped.  So of the frequent tokens' long
lists few contributions are computed, and a task gives out k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.functions.embed import DEFAULT_DIM, hashed_embeddings, token_buckets
from tidepool.functions.text import split_tokens
from tidepool.operators import bm25
from tidepool.session import materialize, ship_package, small_batches
from tidepool.sources.tables import add_new_by_key

SEGMENT_BITS, RANGE = 13, 16
SEGMENT = 1 << SEGMENT_BITS
SEGMENT_POSTINGS = 2_000_000  # a segment of longer chunks ends here, so that its row stays small
QUERY_BYTES = 16 << 20  # of query texts searched for in one pass over the postings
# A segment's row is read in one piece: its row groups stay small, whatever the number of rows.
SEGMENT_FILES = {"compression": "zstd", "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4}
# Tasks write at most so many files of a table per core, one after the other: a process is started for each file (see
# ``session.materialize``).  Large files are read in several tasks, by row groups.
FILES_A_CORE = 16
CHUNK_FILES = {"compression": "zstd", "parquet.block.size": 32 << 20}
SHORT_BYTES, SHORT_ROW = 64 << 20, 256  # of a shortlist that is broadcast; a row takes about so many
LOOK = 2 * SEGMENT  # contributions computed before the k best so far are looked up again
FEW = 64  # of so few candidates all contributions are computed
SCORE_SCALE = 1e12  # scores are sums of whole units, so that their order does not matter


class SearchIndex:
    """The index under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _manifest(self) -> list:
        """One row per generation, in order."""
        try:
            return self.spark.read.parquet(f"{self.path}/manifest/*").orderBy("gen").collect()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return []
            raise

    def _read(self, table: str) -> DataFrame:
        if table in VIEWS:
            return VIEWS[table](self._read("segments"))
        return self.spark.read.parquet(*[f"{self.path}/{table}/{r['gen']}" for r in self._manifest()])

    def add(self, chunks: DataFrame) -> int:
        """Add the chunks (chunk_id, doc_id, start, text) whose id the index does not hold; returns how many."""
        spark, done = self.spark, self._manifest()
        gen, files = len(done), FILES_A_CORE * max(1, self.spark.sparkContext.defaultParallelism)
        new = add_new_by_key(self._read("chunks"), chunks, ["chunk_id"]) if done else chunks
        ship_package(spark)
        small_batches(spark)
        # rebalanced by chunk: one huge document is spread over tasks, and partitions are cut by their size
        lowered = new.hint("rebalance", F.col("doc_id"), F.col("start")).withColumn("_lower", F.lower("text"))
        with_vector = T.StructType([*new.schema.fields, T.StructField("cvec", T.ArrayType(T.FloatType(), False))])
        self._write(lowered.coalesce(files).mapInArrow(_embedding(with_vector), with_vector), "chunks", gen, CHUNK_FILES)
        stored = spark.read.parquet(f"{self.path}/chunks/{gen}").select(
            F.col("doc_id").cast("long"), F.col("start").cast("long"), F.lower("text").alias("_lower"))
        self._write(stored.coalesce(files).mapInArrow(_segmenting(gen), SEGMENTS), "segments", gen, SEGMENT_FILES)
        written = spark.read.parquet(f"{self.path}/segments/{gen}")
        df = written.select(F.explode(F.arrays_zip("token", "count")).alias("p")).groupBy("p.token").agg(F.sum("p.count").cast("long").alias("df_t"))
        self._write(df.coalesce(files), "frequencies", gen)
        n, tokens = written.agg(F.coalesce(F.sum(F.size("doc_id")), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
        n_docs, n_tokens = n + sum(r["n_added"] for r in done), tokens + (done[-1]["n_tokens"] if done else 0)
        known = [f"{self.path}/frequencies/{g}" for g in range(gen + 1)]
        mean = summed(spark.read.parquet(*known), gen + 1).agg(F.avg(raw_idf(n_docs))).first()[0] or 0.0
        row = spark.createDataFrame([(gen, n, n_docs, n_tokens, mean)], "gen int, n_added long, n_docs long, n_tokens long, mean_idf double")
        self._write(row.coalesce(1), "manifest", gen)
        return n

    def _write(self, rows: DataFrame, table: str, gen: int, options: dict | None = None) -> None:
        rows.write.mode("overwrite").options(**(options or {})).parquet(f"{self.path}/{table}/{gen}")

    def chunks(self) -> DataFrame:
        """(chunk_id, doc_id, start, text, cvec) of every chunk."""
        return self._read("chunks")

    def totals(self) -> DataFrame:
        """One row: n_docs (chunks), n_tokens and the vocabulary's mean idf (at six decimals)."""
        last = self._manifest()[-1]
        return self.spark.createDataFrame([(last["n_docs"], last["n_tokens"], round(last["mean_idf"], 6))], "n_docs long, n_tokens long, mean_idf double")

    def vocabulary(self) -> DataFrame:
        """(token, df_t, idf) over all generations, with the epsilon floor."""
        manifest = self._manifest()
        return with_idf(summed(self._read("frequencies"), len(manifest)), manifest[-1]["n_docs"], manifest[-1]["mean_idf"])

    def keyword_top_k(self, queries: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """BM25 search (R11): ``(query_id, chunk_id, doc_id, start, score, rank)``, the k best chunks per row of ``queries``
        (query_id, text).

        Every query gets k chunks where there are as many: chunks without a shared token
        score 0, and equal scores rank by (doc_id, start), whole numbers.  Queries are searched for in
        passes of at most ``query_bytes`` of text.
        """
        spark, manifest = self.spark, self._manifest()
        if not manifest or not manifest[-1]["n_docs"]:
            return queries.where("false").selectExpr("query_id", "cast(null as string) as chunk_id", "cast(null as long) as doc_id",
                                                     "cast(null as long) as start", "cast(null as double) as score", "cast(null as int) as rank")
        ship_package(spark)
        small_batches(spark)
        total = manifest[-1]
        numbered = materialize(queries.select(F.monotonically_increasing_id().alias("_q"), "query_id", "text"), "queries")
        size, n = numbered.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64), F.lit(0)), F.count(F.lit(1))).first()
        passes = -(-size // query_bytes)
        idf = self.vocabulary().select("token", "idf")
        keys = ["doc_id", "start"]
        # the k chunks that answer a query without any match: they are candidates of every query
        first = self.chunks_at().orderBy(*keys).limit(k).collect()
        fillers = {(r["segment"], r["number"]) for r in first}
        found = spark.createDataFrame([], HIT)
        for at in range(passes):
            here = F.pmod(F.xxhash64("_q"), F.lit(passes)) == at
            wanted = {r["_q"]: [] for r in numbered.where(here).select("_q").collect()}
            # a pass has few tokens, so that the vocabulary is not moved
            for r in idf.join(F.broadcast(bm25.query_tokens(numbered.where(here), "_q")), "token").select("_q", "token", "qtf", "idf").collect():
                wanted[r["_q"]].append((r["token"], r["qtf"], r["idf"]))
            if not wanted:
                continue
            found = found.unionByName(self._read("segments").mapInArrow(_searching(wanted, fillers, total["n_tokens"] / total["n_docs"], k), HIT))
        best = W.partitionBy("_q").orderBy(F.desc("units"), *keys)
        top = (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
               .join(numbered.select("_q", "query_id"), "_q").select("query_id", *keys, (F.col("units") / F.lit(SCORE_SCALE)).alias("score"), "rank"))
        return self.chunks().select("chunk_id", *keys).join(shortlisted(top, n * k), keys).select("query_id", "chunk_id", *keys, "score", "rank")

    def chunks_at(self) -> DataFrame:
        """(doc_id, start, segment, number): the place of every chunk."""
        arrays = F.arrays_zip("number", "doc_id", "start")
        return self._read("heads").select("segment", F.explode(arrays).alias("p")).select("p.doc_id", "p.start", "segment", "p.number")


SEGMENTS = ("segment long, n_tokens long, doc_id array<long>, start array<long>, dl array<int>, "  # by chunk number
            "token array<string>, begin array<int>, count array<int>, "  # by token: where its postings are
            "number binary, tf binary")  # of all postings, packed: arrays would pass the JVM number by number


def packed(number: np.ndarray, tf: np.ndarray) -> list[bytes]:
    """The cells ``number`` (each as its distance from the one before, modulo 2 ** 16) and ``tf``."""
    return [np.diff(number.astype("<u2"), prepend=np.uint16(0)).astype("<u2").tobytes(), tf.astype("<i4").tobytes()]


def unpacked(number: pa.Scalar, tf: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(number.as_buffer(), "<u2"), dtype=np.uint16), np.frombuffer(tf.as_buffer(), "<i4")


UNPACKED = "segment long, dl array<int>, token array<string>, begin array<int>, count array<int>, number array<int>, tf array<int>"


def _unpacking():
    schema = to_arrow_schema(T._parse_datatype_string(UNPACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lists = [pa.array([x], pa.list_(pa.int32())) for x in unpacked(batch.column("number")[i], batch.column("tf")[i])]
                cells = [batch.column(f.name).slice(i, 1) for f in list(schema)[:-2]]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for f, x in zip(schema, [*cells, *lists], strict=True)], schema=schema)

    return run


def _postings(segments: DataFrame) -> DataFrame:
    """(segment, token, number, tf, dl): one row per token of a segment, its postings by number."""
    held = "slice({}, x.begin + 1, x.count)"
    return segments.mapInArrow(_unpacking(), UNPACKED).selectExpr("segment", f"""inline(transform(arrays_zip(token, begin, count), x -> struct(x.token as token,
        transform({held.format('number')}, n -> int(n)) as number, {held.format('tf')} as tf, transform({held.format('number')}, n -> dl[int(n)]) as dl)))""")


def _heads(segments: DataFrame) -> DataFrame:
    """(segment, number, doc_id, start): one row per segment, the places of its chunks."""
    return segments.select("segment", F.sequence(F.lit(0), F.size("doc_id") - 1).alias("number"), "doc_id", "start")


VIEWS = {"postings": _postings, "heads": _heads}


def _embedding(fields: T.StructType):
    """Adds the vectors of lower-cased texts; a token is hashed once per batch."""
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, tokens = split_tokens(batch.column("_lower"))
            vectors = hashed_embeddings(row, token_buckets(tokens)[code], batch.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * DEFAULT_DIM), pa.array(vectors.ravel()))
            columns = [batch.column(f.name) for f in arrow if f.name != "cvec"]
            yield pa.RecordBatch.from_arrays([*columns, lists.cast(arrow.field("cvec").type)], schema=arrow)

    return run


class Segment:
    """Chunks that follow each other and their postings, slice by slice."""

    def __init__(self):
        self.rows = self.postings = self.n_tokens = 0
        self.places, self.lengths, self.tokens, self.parts = [], [], [], []
        self.codes = 0  # of all slices' tokens, one after the other

    def add(self, part: pa.RecordBatch) -> None:
        row, code, tokens = split_tokens(part.column("_lower"))
        key, tf = np.unique(code * SEGMENT + row, return_counts=True)
        self.parts.append((key // SEGMENT + self.codes, key % SEGMENT + self.rows, tf))
        self.tokens.append(tokens)
        self.places.append((part.column("doc_id"), part.column("start")))
        self.lengths.append(np.bincount(row, minlength=part.num_rows))
        self.rows, self.codes = self.rows + part.num_rows, self.codes + len(tokens)
        self.postings, self.n_tokens = self.postings + len(key), self.n_tokens + len(row)

    def row(self, segment: int, schema: pa.Schema) -> pa.RecordBatch:
        coded = pa.concat_arrays(self.tokens).dictionary_encode()  # slices may share tokens
        code, number, tf = (np.concatenate(x) for x in zip(*self.parts))
        code = coded.indices.to_numpy()[code].astype(np.int64)
        order = np.argsort(code * SEGMENT + number)
        count = np.bincount(code, minlength=len(coded.dictionary))
        doc_id, start = (pa.concat_arrays(x) for x in zip(*self.places))
        lists = [doc_id, start, np.concatenate(self.lengths), coded.dictionary, np.cumsum(count) - count, count]
        cells = [pa.array([segment]), pa.array([self.n_tokens])]
        for f, values in zip(list(schema)[2:-2], lists, strict=True):
            values = (pa.array(values) if isinstance(values, np.ndarray) else values).cast(f.type.value_type)
            cells.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(f.type))
        cells += [pa.array([x], f.type) for f, x in zip(list(schema)[-2:], packed(number[order], tf[order]), strict=True)]
        return pa.RecordBatch.from_arrays(cells, schema=schema)


def _segmenting(gen: int):
    schema = to_arrow_schema(T._parse_datatype_string(SEGMENTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = (gen << 44) + (TaskContext.get().partitionId() << 20), Segment()
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                part = batch.slice(begin, SEGMENT - held.rows)
                held.add(part)
                begin += part.num_rows
                if held.rows == SEGMENT or held.postings >= SEGMENT_POSTINGS:
                    yield held.row(at, schema)
                    at, held = at + 1, Segment()
        if held.rows:
            yield held.row(at, schema)

    return run


def summed(frequencies: DataFrame, generations: int) -> DataFrame:
    """(token, df_t) over the generations; one alone has a row per token."""
    if generations == 1:
        return frequencies.select("token", "df_t")
    return frequencies.groupBy("token").agg(F.sum("df_t").cast("long").alias("df_t"))


def shortlisted(rows: DataFrame, most: int) -> DataFrame:
    """A shortlist of at most ``most`` rows to join with the chunks: sent to where they lie, so that they are not
    shuffled for it, unless it is large itself."""
    return F.broadcast(rows) if most * SHORT_ROW <= SHORT_BYTES else rows


def raw_idf(n_docs: int):
    return F.log(F.lit(float(n_docs)) - F.col("df_t") + 0.5) - F.log(F.col("df_t") + 0.5)


def with_idf(df: DataFrame, n_docs: int, mean_idf: float) -> DataFrame:
    """Add ``idf``: a negative one becomes ``EPSILON`` times the vocabulary's mean."""
    raw = raw_idf(n_docs)
    return df.withColumn("idf", F.when(raw < 0, F.lit(mean_idf * bm25.EPSILON)).otherwise(raw))


HIT = "_q long, doc_id long, start long, units long"


def parts(tf: np.ndarray, dl: np.ndarray, avgdl: float) -> np.ndarray:
    """What postings add per unit of weight."""
    tf = tf.astype(np.float64)
    norm = bm25.K1 * ((1 - bm25.B) + bm25.B * dl / avgdl)
    return tf * (bm25.K1 + 1) / (tf + norm)


class TokenList:
    """A token's postings in a segment, by number: what one of them adds per unit of weight, and the largest in each range."""

    def __init__(self, number: np.ndarray, tf: np.ndarray, dl: np.ndarray, avgdl: float):
        self._hold(number, parts(tf, dl, avgdl))

    @classmethod
    def of(cls, number: np.ndarray, part: np.ndarray) -> TokenList:
        """From what each posting adds."""
        self = cls.__new__(cls)
        self._hold(number, part)
        return self

    def _hold(self, number: np.ndarray, part: np.ndarray) -> None:
        self.number, self.part, self.largest, self._units, self._most = number, part, float(part.max()), {}, None

    def units(self, weight: float) -> np.ndarray:
        """What each posting adds to a query that gives the token this weight; kept, as queries share tokens."""
        if weight not in self._units:
            self._units[weight] = np.floor(weight * self.part * SCORE_SCALE).astype(np.int64)
        return self._units[weight]

    def most(self) -> np.ndarray:
        """The largest part in each range of the segment."""
        if self._most is None:
            of = self.number // RANGE
            begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            self._most = np.zeros(SEGMENT // RANGE)
            self._most[of[begin]] = np.maximum.reduceat(self.part, begin)
        return self._most


class TopHits:
    """The k best (units, doc_id, start) of a query so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.zeros((3, 0), np.int64)

    @property
    def to_beat(self) -> float:
        return self.rows[0, -1] if self.rows.shape[1] >= self.k else -np.inf

    def raised(self, to_beat: float, units: np.ndarray) -> float:
        """What a chunk has to reach, given that there are chunks that have so many ``units``."""
        return max(to_beat, np.partition(units, -self.k)[-self.k]) if len(units) >= self.k else to_beat

    def merge(self, units: np.ndarray, doc_id: np.ndarray, start: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([units, doc_id, start])], axis=1)
        self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[:self.k]]


def search_segment(words: list[tuple[TokenList, float]], doc_id: np.ndarray, start: np.ndarray, fillers: list[int], top: TopHits) -> int:
    """One query's hits of a segment into ``top``; returns how many contributions were computed.

    ``words`` has the token lists with their weights (repeats times idf), ``doc_id`` and
    ``start`` are by chunk number; ``fillers`` are candidates without a match too, until others beat them.
    """
    bounds = [max(int(w * t.largest * SCORE_SCALE), 0) for t, w in words]
    # weights below zero first, so that a sum only grows from there on; then the strongest
    order = sorted(range(len(words)), key=lambda i: (words[i][1] >= 0, -bounds[i]))
    rest = sum(bounds)  # what the tokens from here on can add together
    units, hit = np.zeros(SEGMENT, np.int64), np.zeros(SEGMENT, bool)
    hit[fillers] = True
    to_beat, computed, candidates, reached, looked = top.to_beat, 0, None, 0, 0
    for i in order:
        t, weight = words[i]
        # the k best so far will have at least what they have; looked up where that can end the search for candidates
        if candidates is None and weight >= 0 and to_beat <= rest < reached and computed >= looked:
            to_beat, looked = top.raised(to_beat, units[units > to_beat] if to_beat >= 0 else units[hit]), computed + LOOK
        if candidates is None and weight >= 0 and rest < to_beat:  # a chunk without any token so far cannot be among the best
            candidates = np.flatnonzero(hit)
            candidates = candidates[units[candidates] + rest >= to_beat]
        rest -= bounds[i]
        if candidates is None:
            units[t.number] += t.units(weight)
            hit[t.number] = True
            computed += len(t.number)
            reached += bounds[i]
            continue
        if len(candidates) > FEW:
            most = np.floor(weight * t.most() * SCORE_SCALE).astype(np.int64)
            candidates = candidates[units[candidates] + most[candidates // RANGE] + rest >= to_beat]
        if not len(candidates):
            return computed
        at = np.minimum(np.searchsorted(t.number, candidates), len(t.number) - 1)
        found = t.number[at] == candidates
        units[candidates[found]] += t.units(weight)[at[found]]
        computed += int(np.count_nonzero(found))
        to_beat = top.raised(to_beat, units[candidates])
        candidates = candidates[units[candidates] + rest >= to_beat]
    candidates = np.flatnonzero(hit) if candidates is None else candidates
    candidates = candidates[units[candidates] >= to_beat]
    if len(candidates):
        top.merge(units[candidates], doc_id[candidates], start[candidates])
    return computed


def _padded(values: pa.Array) -> np.ndarray:
    """A number of every chunk of a segment, in room for ``SEGMENT``; a null one is below all others."""
    whole = np.zeros(SEGMENT, np.int64)
    whole[:len(values)] = values.fill_null(np.iinfo(np.int64).min).to_numpy()
    return whole


def _searching(wanted: dict[int, list[tuple[str, int, float]]], fillers: set[tuple[int, int]], avgdl: float, k: int):
    schema = pa.schema([(f.split(" ")[0], pa.int64()) for f in HIT.split(", ")])
    tokens = pa.array(sorted({t for words in wanted.values() for t, _, _ in words}), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = {q: TopHits(k) for q in wanted}

        for batch in batches:
            for i in range(batch.num_rows):
                cells = {c: batch.column(c)[i].values for c in ("token", "begin", "count", "dl")}
                doc_id, start = (_padded(batch.column(c)[i].values) for c in ("doc_id", "start"))
                at = np.flatnonzero(pc.is_in(cells["token"], value_set=tokens).to_numpy(zero_copy_only=False))
                named = cells["token"].take(pa.array(at)).to_pylist()
                begin, count, dl = (cells[c].to_numpy() for c in ("begin", "count", "dl"))
                number, tf = unpacked(batch.column("number")[i], batch.column("tf")[i])
                begin, count = begin[at].astype(np.int64), count[at].astype(np.int64)
                ends = np.cumsum(count)
                held = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - count), count)  # the named tokens' postings
                number = number[held].astype(np.int64)
                part = parts(tf[held], dl[number], avgdl)
                lists = {token: TokenList.of(number[b - n:b], part[b - n:b]) for token, b, n in zip(named, ends.tolist(), count.tolist())}
                segment = batch.column("segment")[i].as_py()
                always = [n for s, n in fillers if s == segment]
                for q, words in wanted.items():
                    held = [(lists[t], qtf * idf) for t, qtf, idf in words if t in lists]
                    if held or always:
                        search_segment(held, doc_id, start, always, tops[q])
        rows = [np.concatenate([np.full((1, t.rows.shape[1]), q), t.rows[[1, 2, 0]]]) for q, t in tops.items()]
        table = np.concatenate(rows, axis=1) if rows else np.zeros((4, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in table], schema=schema)

    return run
