"""Approximate vector search with a dial and a proof (R7): an inverted file of cells, with triangle-inequality bounds.

Centres are drawn from a bounded sample (``sample`` rows at most) by a few rounds of Lloyd's
method.  Every vector goes to its nearest centre; a cell keeps its vectors' distances
to the centre.  For a query at distance d of a centre, a vector at distance r of that centre is at
least |d - r| away, so with a k-th best distance at hand whole cells, and within a cell all
but a ring of radii, are left out without being compared and without losing anything.

``probes`` is the dial: only so many cells nearest to the query are looked into.  With
all cells (the default) the answer is exact.  Queries go to the tasks in blocks of bounded
bytes; each task keeps the k best per query over the cells that it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS, SAMPLE, ROUNDS, BLOCK_BYTES = 64, 20_000, 8, 32 << 20
SLACK = 1e-9  # room for rounding in the bounds; distances compare at nine decimals
CELL_ROWS = 10_000  # vectors of a cell compared in one step


def centres(items: DataFrame, vec_col: str, id_col: str, cells: int = CELLS, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``cells`` centres, from the ``sample`` rows with the least hash of their id (the same for any partitioning)."""
    rows = items.where(F.col(vec_col).isNotNull()).select(vec_col, F.xxhash64(id_col).alias("_h"), id_col).orderBy("_h", id_col).limit(sample).collect()
    if not rows:
        return np.zeros((0, 0))
    points = np.array([r[0] for r in rows], dtype=np.float64)
    centre = np.unique(points[:cells], axis=0)
    for _ in range(rounds):
        nearest = _distances(points, centre).argmin(axis=1)
        held = np.unique(nearest)
        centre = np.stack([points[nearest == c].mean(axis=0) for c in held])
    return centre


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def assign(items: DataFrame, centre: np.ndarray, vec_col: str, id_col: str) -> DataFrame:
    """(id, vec, cell, radius) of every vector: its nearest centre and the distance to it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                away = _distances(np.stack(pdf["vec"].to_numpy()).astype(np.float64), centre)
                cell = away.argmin(axis=1)
                yield pdf.assign(cell=cell.astype(np.int32), radius=away[np.arange(len(pdf)), cell])

    from tidepool.session import ship_package
    ship_package(items.sparkSession)
    narrow = items.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return narrow.mapInPandas(run, "id long, vec array<double>, cell int, radius double")


class _Nearest:
    """The k nearest (distance, id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.away, self.ids = k, np.zeros(0), np.zeros(0, np.int64)

    @property
    def reach(self) -> float:
        return self.away[-1] if len(self.away) >= self.k else math.inf

    def merge(self, away: np.ndarray, ids: np.ndarray) -> None:
        away, ids = np.append(self.away, away), np.append(self.ids, ids)
        order = np.lexsort((ids, away))[:self.k]
        self.away, self.ids = away[order], ids[order]


def search_cell(query: np.ndarray, to_centre: float, radius: np.ndarray, vectors: np.ndarray, ids: np.ndarray, near: _Nearest) -> int:
    """The k nearest of one run of a cell's vectors, sorted by radius, into ``near``; returns how many were compared."""
    low, high = np.searchsorted(radius, (to_centre - near.reach - SLACK, to_centre + near.reach + SLACK))
    ring = slice(low, high)
    away = np.round(np.sqrt(((vectors[ring] - query) ** 2).sum(axis=1)), 9)
    near.merge(away, ids[ring])
    return high - low


def _searching(qids: list, queries: np.ndarray, centre: np.ndarray, probed: list[set], k: int, out: Sequence[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near = [_Nearest(k) for _ in qids]
        to_centre = _distances(queries, centre)

        def finish(cell: int, rows: list[tuple]) -> None:
            radius, ids = np.array([r for r, _, _ in rows]), np.array([i for _, i, _ in rows])
            vectors = np.stack([v for _, _, v in rows])
            for q in range(len(qids)):
                if cell in probed[q]:
                    search_cell(queries[q], to_centre[q, cell], radius, vectors, ids, near[q])

        held, rows = None, []
        for pdf in batches:
            for cell, radius, i, vec in zip(pdf["cell"], pdf["radius"], pdf["id"], pdf["vec"]):
                if cell != held or len(rows) >= CELL_ROWS:  # a large cell is searched ring by ring
                    if rows:
                        finish(held, rows)
                    held, rows = cell, []
                rows.append((radius, i, vec))
        if rows:
            finish(held, rows)
        yield pd.DataFrame({out[0]: [q for q, n in zip(qids, near) for _ in n.ids], out[1]: np.concatenate([n.ids for n in near]),
                            out[2]: np.concatenate([n.away for n in near])})

    return run


def top_k(items: DataFrame, queries: DataFrame, k: int, vec_col: str, id_col: str, probes: int | None = None, cells: int = CELLS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, id_col, distance, rank): the k nearest items by Euclidean distance at nine decimals, ties by id.

    ``queries`` has query_id and qvec.  ``probes`` cells are looked into per query, all by
    default: then the answer is exact.  Fewer may miss neighbours, and may find fewer than k
    where the probed cells hold fewer.  Items without a vector are left out; ids are whole numbers.
    """
    from tidepool.session import materialize
    spark = items.sparkSession
    kind = queries.schema["query_id"].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField(id_col, T.LongType()), T.StructField("distance", T.DoubleType())])
    centre = centres(items, vec_col, id_col, cells)
    found = spark.createDataFrame([], schema)
    if len(centre):
        # cells are spread over tasks by cell and a hash of the id, so that a cell of a third of all rows is not one task
        placed = materialize(assign(items, centre, vec_col, id_col), "cells")
        dealt = placed.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("cell", "radius", "id")
        size = queries.agg(F.coalesce(F.sum(F.size("qvec") * 8 + 64), F.lit(0))).first()[0]
        blocks = max(1, math.ceil(size / block_bytes))
        for block in range(blocks):
            rows = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).where("qvec is not null").select("query_id", "qvec").collect()
            if rows:
                qmat = np.array([r[1] for r in rows], dtype=np.float64)
                nearest = np.argsort(_distances(qmat, centre), axis=1, kind="stable")[:, :probes]
                run = _searching([r[0] for r in rows], qmat, centre, [set(n) for n in nearest.tolist()], k, schema.names)
                found = found.unionByName(dealt.mapInPandas(run, schema))
    best = W.partitionBy("query_id").orderBy("distance", id_col)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
