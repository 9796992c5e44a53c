"""Alignment of two tokenizers over a corpus: how tokens of A and B overlap, and how often each pair does.

Both encode the same bytes.  Offsets where a token of A and one of B both end cut a
text into groups.  Nearly all groups are one token on either side with the same bytes,
so an array maps each A id to the B id of those bytes; such groups are counted in a
vector as long as A's vocabulary, and need no pair at all.  Only the pairs of the other
groups are counted as pairs: a task numbers the distinct pairs of a block of
documents, keeps for each document the numbers of its pairs, and sends one row per pair
and block to the shuffle, however often the pair comes in the block.

The totals then come back the same way: one row per pair and block, sorted before the
block's documents, whose sums are taken from an array.  The totals of the one-to-one
pairs and the best of each B id are vectors of vocabulary length in every task.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import gather, offset_table, small_batches
from tidepool.llm.rank_bpe import rank_encoder
from tidepool.session import materialize, ship_package

BLOCK_LINKS = 1_000_000  # links of irregular groups in a block; it ends with the document that reaches them
SLICE_CHARS = 400_000  # of texts aligned at once

# A row is a pair of a block (kind 0; without number: a one-to-one pair of a task) or a document (kind 1).
CODED = ("kind int, block long, number int, a int, b int, n long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, regular binary, irregular binary")
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


class Aligner:
    """The two tokenizers, their tokens' bytes, and the map from A ids to B ids of the same bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = rank_encoder(path_a, False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode("utf-8") for p, is_byte in pieces]
        first: dict[bytes, int] = {}
        for i, ((_, is_byte), raw) in enumerate(zip(pieces, self.bytes_b)):
            if not is_byte:
                first.setdefault(raw, i)
        self.same = np.array([first.get(raw, -1) for raw in self.a.bytes], np.int64)
        self.blob_a, self.offsets_a = offset_table(self.a.bytes)
        self.blob_b, self.offsets_b = offset_table(self.bytes_b)
        # decimal ids with the sign that follows them: within a side, after side A, after a group
        self.table, self.table_offsets = offset_table([b"%d%c" % (i, c) for c in b",|;" for i in range(max(self.a.size, len(pieces)))])
        self.width = max(self.a.size, len(pieces))

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B per text; none where a text is null or empty, or a side's bytes are not space and text."""
        given = [t or "" for t in texts]
        side_a = [self.a.encode(" " + t) if t else np.zeros(0, np.uint32) for t in given]
        side_b = [np.array(ids, np.int64) for ids in self.b.encode(given, num_threads=1)]
        for i, t in enumerate(given):
            raw = b" " + t.encode("utf-8")
            if not t or gather(self.blob_a, self.offsets_a, side_a[i]) != raw or gather(self.blob_b, self.offsets_b, side_b[i]) != raw:
                side_a[i], side_b[i] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return side_a, side_b

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Per text n_a, n_b, n_groups, n_links and the groups' digest; per link its ids, its text and whether its group is one-to-one."""
        side_a, side_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (side_a, side_b))
        zero = np.zeros(len(texts), np.int64)
        if not n_a.sum():
            none = np.zeros(0, np.int64)
            return {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "digests": [""] * len(texts), "a": none, "b": none,
                    "text": none, "one": none.astype(bool)}
        a, b = np.concatenate(side_a).astype(np.int64), np.concatenate(side_b)
        ends_a, ends_b = (np.cumsum(offsets[ids + 1] - offsets[ids]) for offsets, ids in ((self.offsets_a, a), (self.offsets_b, b)))
        # texts lie one after the other; both sides end with each text, so no link or group crosses two
        is_a, is_b = (np.zeros(ends_a[-1] + 1, bool) for _ in "ab")
        is_a[ends_a], is_b[ends_b] = True, True
        ends = np.flatnonzero(is_a | is_b)  # each link is the stretch between two ends
        at_a, at_b = is_a[ends], is_b[ends]
        link_a, link_b = np.cumsum(at_a) - at_a, np.cumsum(at_b) - at_b
        closes = at_a & at_b
        group = np.cumsum(closes) - closes
        n_groups = int(group[-1]) + 1
        links = np.bincount(group, minlength=n_groups)
        text_a = np.repeat(np.arange(len(texts)), n_a)
        text = text_a[link_a]
        one = (links[group] == 1) & (self.same[a[link_a]] == b[link_b])

        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[link_a], group_b[link_b] = group, group
        size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        place_a = np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(size_a)[group_b]
        written = np.empty(len(a) + len(b), np.int64)
        written[place_a] = a + self.width * (np.append(group_a[1:] != group_a[:-1], True))
        written[place_b] = b + 2 * self.width * (np.append(group_b[1:] != group_b[:-1], True))
        to = np.cumsum(self.table_offsets[written + 1] - self.table_offsets[written])
        raw = memoryview(gather(self.table, self.table_offsets, written))
        stop = np.append(0, to)[np.cumsum(n_a + n_b)].tolist()
        digests = [sha256(raw[i:j - 1]).hexdigest() if j > i else "" for i, j in zip([0, *stop], stop)]
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text[closes], minlength=len(texts)), "n_links": np.bincount(text, minlength=len(texts)),
                "digests": digests, "a": a[link_a], "b": b[link_b], "text": text, "one": one}


_LOADED: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two files, loaded once per Python worker."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    return _LOADED[path_a, path_b]


def _slices(batches):
    """Lists of (doc_id, text) of bounded text, or of one text."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append(row)
            size += len(row[1] or "")
            if size >= SLICE_CHARS:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


class _Block:
    """Numbers of the distinct irregular pairs of a run of documents, and how often each comes."""

    def __init__(self, block: int):
        self.block, self.number, self.times, self.links = block, {}, np.zeros(0, np.int64), 0

    def numbered(self, codes: np.ndarray) -> np.ndarray:
        distinct, inverse, times = np.unique(codes, return_inverse=True, return_counts=True)
        numbers = np.array([self.number.setdefault(c, len(self.number)) for c in distinct.tolist()], np.int64)
        self.times = np.append(self.times, np.zeros(len(self.number) - len(self.times), np.int64))
        self.times[numbers] += times
        self.links += len(codes)
        return numbers[inverse].astype("<u4")

    def rows(self) -> dict[str, np.ndarray]:
        codes = np.fromiter(self.number, np.int64, len(self.number))
        return {"block": np.full(len(codes), self.block), "number": np.arange(len(codes)), "a": codes >> 32, "b": codes & 0xFFFFFFFF, "n": self.times}


def _coding(path_a: str, path_b: str, block_links: int):
    schema = _arrow(CODED)

    def batch(kind: int, n: int, columns: dict) -> pa.RecordBatch:
        columns = {"kind": np.full(n, kind)} | columns
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name]).cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        both = aligner(path_a, path_b)
        vector = np.zeros(len(both.same), np.int64)  # one-to-one groups of the task by A id
        block = _Block(TaskContext.get().partitionId() << 32)
        for rows in _slices(batches):
            found = both.align([t for _, t in rows])
            one = found["one"]
            regular = found["a"][one]
            vector += np.bincount(regular, minlength=len(vector))
            irregular = block.numbered(found["a"][~one] << 32 | found["b"][~one])
            cuts = [np.append(0, np.cumsum(np.bincount(found["text"][m], minlength=len(rows)))).tolist() for m in (one, ~one)]
            part = lambda x, c: [x[i:j].tobytes() for i, j in zip(c, c[1:])]
            yield batch(1, len(rows), {"block": np.full(len(rows), block.block), "doc_id": pa.array([i for i, _ in rows], pa.int64()),
                                       **{c: found[c] for c in ("n_a", "n_b", "n_groups", "n_links")}, "groups_sha256": pa.array(found["digests"], pa.string()),
                                       "regular": pa.array(part(regular.astype("<u4"), cuts[0]), pa.binary()),
                                       "irregular": pa.array(part(irregular, cuts[1]), pa.binary())})
            if block.links >= block_links:
                pairs = block.rows()
                yield batch(0, len(pairs["a"]), pairs)
                block = _Block(block.block + 1)
        pairs = block.rows()
        yield batch(0, len(pairs["a"]), pairs)
        held = np.flatnonzero(vector)
        yield batch(0, len(held), {"a": held, "b": both.same[held], "n": vector[held]})

    return run


def _summing(totals: list[tuple[int, int, bool]], size: int):
    """Documents' sums from their block's pair totals, which come before them; ``totals`` are those of the one-to-one pairs by A id."""
    schema = _arrow(RESULT)

    def sums(column: pa.Array, n: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the sum of totals and of best ones over the row's numbers."""
        raw = [x or b"" for x in column.to_pylist()]
        ids = np.frombuffer(b"".join(raw), "<u4")
        ends = np.cumsum([len(x) // 4 for x in raw])
        running = [np.append(0, np.cumsum(x[ids]))[np.append(0, ends)] for x in (n, best)]
        return np.diff(running[0]), np.diff(running[1])

    def run(batches):
        vector, vector_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for a, n, is_best in totals:
            vector[a], vector_best[a] = n, is_best
        block, pair_n, pair_best = None, [], []
        for batch in batches:
            blocks, kinds = (batch.column(c).to_numpy() for c in ("block", "kind"))
            turns = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for start, stop in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                part = batch.slice(start, stop - start)
                if blocks[start] != block:
                    block, pair_n, pair_best = blocks[start], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                if kinds[start] == 0:
                    pair_n.append(part.column("n").to_numpy())
                    pair_best.append(part.column("best").cast(pa.int8()).to_numpy().astype(np.int64))
                    continue
                pair_n, pair_best = [np.concatenate(pair_n)], [np.concatenate(pair_best)]
                one, irregular = sums(part.column("regular"), vector, vector_best), sums(part.column("irregular"), pair_n[0], pair_best[0])
                out = {"n_best": one[1] + irregular[1], "count_sum": one[0] + irregular[0]}
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], pa.int64()) if f.name in out else part.column(f.name) for f in schema], schema=schema)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS) -> tuple[DataFrame, DataFrame]:
    """Alignment of tokenizers A (byte-level BPE, JSON) and B (sentencepiece model) over ``docs`` (doc_id, text; other columns are not read).

    Returns a row per document: doc_id, n_a, n_b, n_groups, n_links (pairs of overlapping
    tokens), n_best (links whose pair is the most frequent of its B id, ties included),
    count_sum (over links, of their pair's number of links in the corpus) and
    groups_sha256; and the table of pairs: a, b, n (links of the corpus), best.

    A null or empty text, or one that a tokenizer changes, has no tokens: zeros and an
    empty digest.  Null doc_ids stay null; repeated rows count each; an empty table gives
    empty results.  A text of any length is one document of one block.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    coded = materialize(docs.select("doc_id", "text").mapInArrow(_coding(path_a, path_b, block_links), CODED), "alignment")
    rows = coded.where("kind = 0").select("block", "number", "a", "b", "n")
    counts = materialize(rows.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max(F.col("number").isNull()).alias("one")), "pair-counts")
    most = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))  # at most B's vocabulary
    pairs = counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"), "one")
    totals = [tuple(r) for r in pairs.where("one").select("a", "n", "best").collect()]  # at most A's vocabulary
    looked = rows.where("number is not null").drop("n").join(pairs, ["a", "b"])
    first = looked.select("block", F.lit(0).alias("kind"), "number", "n", "best")
    then = coded.where("kind = 1").drop("a", "b", "n")
    both = first.unionByName(then, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind", "number")
    size = max([a for a, _, _ in totals], default=0) + 1
    return both.mapInArrow(_summing(totals, size), RESULT), pairs.drop("one")
