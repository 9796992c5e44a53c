"""Distributed connected components over an edge table, by alternating star contraction.

Every pass points each node at the smallest node it sees; passes alternate
between larger and smaller neighbours, so that each component shrinks to a star
around its smallest node in a number of passes that grows with the logarithm of
its size.  Edges are written to the shared checkpoint folder after each pass, so
a lost executor costs one pass, and only a count and a checksum reach the driver.

Before the passes, blocks of at most ``BLOCK`` edges are contracted where they lie: a
block's edges are replaced by stars that connect the same nodes.  An edge table of
one block is thereby solved at once; larger ones go on with fewer edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.session import materialize, ship_package

BLOCK = 500_000


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its listed neighbours; partial sums make hot nodes cheap."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_minimum(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down)
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node reachable from each) of one block of edges, by hooking and pointer jumping."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b, label = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (a, b):
            np.minimum.at(new, label[ends], low)
            np.minimum.at(new, ends, low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _contract(edges: DataFrame, blocks: int) -> DataFrame:
    """Edges (u, v) with each of ``blocks`` shares replaced by stars around its smallest nodes."""
    ship_package(edges.sparkSession)
    arrow = to_arrow_schema(edges.schema)

    def run(batches):
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if held:
            nodes, low = smallest_reachable(*map(np.concatenate, zip(*held)))
            far = nodes != low
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(low[far])], schema=arrow)

    return edges.coalesce(blocks).mapInArrow(run, edges.schema)


def components(edges: DataFrame, u: str = "u", v: str = "v", files: int | None = None) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Self loops and rows with a null end are ignored; repeated edges count once.
    An empty edge table gives an empty result.  ``files``: see ``materialize``.
    """
    cur = materialize(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct(), "edges", files)
    blocks = -(-cur.count() // BLOCK)
    if blocks:
        cur = materialize(_contract(cur if blocks == 1 else cur.repartition(blocks), blocks), "edges")
    if blocks > 1:
        before = _state(cur)
        while True:
            cur = materialize(_small_star(_large_star(cur)), "edges", files)
            now = _state(cur)
            if now == before:
                break
            before = now
    centres = cur.select(F.col("v").alias("node")).distinct()
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(centres.select("node", F.col("node").alias("component"))))
