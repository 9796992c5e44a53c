"""Best-fit packing online, in bounded space: a fixed number of open bins, the fullest closes first.

Every task packs the documents it reads as they come.  Open bins are kept by their
free space, with one bit per size of free space that some open bin has; the bin that
a piece fits best is the lowest set bit at or above its length.  A piece that fits
nowhere opens a bin, and where that makes more than ``open_bins``, the fullest one
(the lowest set bit of all) closes.  A bin's pieces leave the task when it closes, so
a task holds at most ``open_bins`` bins.

At a task's end its open bins are dissolved: their pieces, at most ``open_bins``
sequences of ids whatever the task read, are packed again by an eighth of the tasks or
less, until one task is left, whose bins all close.  So only the last task leaves bins
that are badly filled, and no other ids move between tasks.  Pieces come to later tasks
in an order that mixes long and short ones, as documents do; longest first would close
bins before the short pieces come that fill them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import small_batches
from tidepool.llm.rank_bpe import rank_encoder
from tidepool.session import materialize, ship_package

LENGTH, END_ID = 1024, 2
OPEN_BINS = 256
FAN_IN = 8  # a later task takes the open bins of at least so many tasks

PIECE = "row long, doc_id long, piece int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split(" ") for f in PIECE.split(", "))])
_FIELDS = _ARROW.names
_LENGTH_AT, _SEQUENCE_AT, _OFFSET_AT = (_FIELDS.index(f) for f in ("length", "sequence_id", "offset"))


class OpenBins:
    """Open bins by free space.  ``put`` returns the bins that close by it, each a list of pieces with their offsets."""

    def __init__(self, length: int, limit: int):
        self.length, self.limit, self.count = length, limit, 0
        self.free_bits = 0  # bit f is set if an open bin has f places free
        self.by_free: list[list[list]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        self.count -= 1
        return taken

    def put(self, size: int, piece: object) -> list[list]:
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            held = self._take(free)
        else:
            free, held = self.length, []
        held.append((self.length - free, piece))
        free -= size
        if not free:
            return [held]
        self.by_free[free].append(held)
        self.free_bits |= 1 << free
        self.count += 1
        if self.count <= self.limit:
            return []
        return [self._take((self.free_bits & -self.free_bits).bit_length() - 1)]

    def rest(self) -> list[list]:
        return [held for bins in self.by_free for held in bins]


class _Sequences:
    """Pieces of closed bins as record batches; sequence numbers are unique by level, task and bin."""

    def __init__(self, level: int, length: int, limit: int):
        self.bins = OpenBins(length, limit)
        self.next = (level << 58) + (TaskContext.get().partitionId() << 32)
        self.rows: list[tuple] = []

    def put(self, piece: tuple) -> None:
        for held in self.bins.put(piece[_LENGTH_AT], piece):
            self.close(held)

    def close(self, held: list) -> None:
        self.rows += [(*piece[:_SEQUENCE_AT], self.next, offset) for offset, piece in held]
        self.next += 1

    def batches(self, at_least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > at_least:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            self.rows = []

    def end(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Closes what is open, or gives it out without a sequence."""
        for held in self.bins.rest():
            if last:
                self.close(held)
            else:
                self.rows += [(*piece[:_SEQUENCE_AT], None, None) for _, piece in held]
            yield from self.batches(2000)
        yield from self.batches(0)


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: whole sequences but for the first, which takes the remainder."""
    starts = range(n % length, n, length)
    return ([(0, n % length)] if n % length else []) + [(s, length) for s in starts]


def _first_level(path: str, length: int, end_id: int, limit: int):
    def run(batches):
        encoder = rank_encoder(path, True)
        out = _Sequences(0, length, limit)
        for batch in batches:
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.append(encoder.encode(text or ""), np.uint32(end_id)).astype("<u4", copy=False)
                for k, (start, size) in enumerate(cut(len(ids), length)):
                    out.put((row, doc, k, start, size, ids[start:start + size].tobytes(), len(ids), None, None))
                yield from out.batches(2000)
        yield from out.end(False)
    return run


def _later_level(level: int, length: int, limit: int, last: bool):
    def run(batches):
        out = _Sequences(level, length, limit)
        for batch in batches:
            for piece in zip(*(c.to_pylist() for c in batch.columns)):
                out.put(piece)
            yield from out.batches(2000)
        yield from out.end(last)
    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are not read) into sequences of at most ``length`` ids.

    One row per piece: doc_id, piece (from 0), start (ids of its document before it),
    length, ids (binary, little-endian unsigned 32-bit), doc_tokens (with the end id),
    sequence_id (any number) and offset (place in the sequence, without gaps from 0).
    Only documents of more than ``length`` ids are cut.  A null or empty text is the end id
    alone; a null doc_id stays null; repeated rows are packed each; pieces of equal length
    of one task are told apart by their rows; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    packed = materialize(rows.mapInArrow(_first_level(path, length, end_id, open_bins), PIECE), "best-fit-0")
    levels, level, tasks = [packed.where("sequence_id is not null")], 0, None
    while True:
        left = packed.where("sequence_id is null")
        tokens = left.agg(F.sum("length")).first()[0]
        if not tokens:
            break
        wanted = -(-tokens // (FAN_IN * open_bins * length))
        tasks = max(1, wanted if tasks is None else min(wanted, tasks // 2))
        level += 1
        spread = left.repartition(tasks) if tasks > 1 else left.coalesce(1)
        ordered = spread.sortWithinPartitions(F.xxhash64("row", "piece"), "row", "piece")
        packed = materialize(ordered.mapInArrow(_later_level(level, length, open_bins, tasks == 1), PIECE), f"best-fit-{level}")
        levels.append(packed.where("sequence_id is not null"))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.drop("row")
