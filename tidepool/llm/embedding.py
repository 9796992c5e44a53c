"""Embedding near-dedup: sign hashes of random hyperplanes, exact cosine, connected components.

Vectors are compared only within a label.  Equal vectors of a label are one class.
Each of ``TABLES`` tables hashes a class by the signs of ``BITS`` random projections;
classes that share a bucket of some table are candidates, and a pair is linked if
its cosine, in double precision, reaches the threshold.

Links are counted, not listed: a class gets the number of vectors that its partners
stand for, a pair is counted in the first table in which it meets, and of the links
only a forest that connects the same classes is kept for the components.  A bucket
of more than ``BLOCK`` classes is cut into blocks, and every two blocks meet in a
task of their own, so no bucket is gathered whole and none is capped.

Probability that two vectors at cosine 0.93 share none of the 160 buckets of 20 bits:
(1 - (1 - acos(0.93) / pi) ** 20) ** 160, about 2 in a million.  Unrelated vectors of a
label share a bucket once in a million, so few rows go on with their vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidepool.llm.common import map_slices, mix64
from tidepool.llm.components import components, smallest_reachable
from tidepool.session import materialize, ship_package

COSINE, TABLES, BITS, BLOCK = 0.93, 160, 20, 1024  # at most 32 bits
CELLS = 4_000_000  # vector components gathered at once in a task


def _signing(tables: int, bits: int, seed: int):
    def make():
        planes: dict[int, np.ndarray] = {}
        powers = (1 << np.arange(bits, dtype=np.int64))

        def step(cols):
            signs, units = [], []
            for v in cols["embedding"]:
                x = np.array([np.nan if c is None else c for c in v] if v else [0.0], np.float64)
                scale = np.abs(x).max()
                if not np.isfinite(x).all() or not scale:
                    signs.append(None)
                    units.append(None)
                    continue
                x = x / scale  # huge and tiny components keep a finite length
                x = x / np.sqrt(x @ x)
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng((seed, len(x))).standard_normal((len(x), tables * bits))
                on = (x @ planes[len(x)] >= 0).reshape(tables, bits)
                signs.append((on @ powers).astype("<u4").tobytes())
                units.append(x.astype("<f8").tobytes())
            return {"vec_id": cols["vec_id"], "label": cols["label"], "signs": signs, "unit": units}
        return step
    return make


def _pairs(start: np.ndarray, end: np.ndarray, side: np.ndarray, alone: np.ndarray, share: int):
    """Index pairs i < j within groups, of different sides unless the group is one block with itself; ``share`` at a time."""
    counts = end - np.arange(len(end)) - 1
    total = np.cumsum(counts)
    at = 0
    while at < len(counts):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + share, "right")))
        i = np.repeat(np.arange(at, upto), counts[at:upto])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(counts[at:upto]) - counts[at:upto], counts[at:upto])
        keep = alone[i] | (side[i] != side[j])
        yield i[keep], j[keep]
        at = upto


KEY = ("label", "dim", "table", "sign", "x", "y")  # a group: two blocks x and y of one bucket


def _comparing(threshold: float, schema):
    """Step over rows sorted by ``KEY``: link counts of the members of each group, and edges that connect them."""
    def compare(key, side, ident, many, signs, units):
        n, table = len(key), key[:, 2]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        size = np.diff(np.append(new, n))
        weight, edges = np.zeros(n, np.int64), []
        for i, j in _pairs(np.repeat(new, size), np.repeat(new + size, size), side, key[:, 4] == key[:, 5], 1 + CELLS // units.shape[1]):
            near = np.einsum("ij,ij->i", units[i], units[j]) >= threshold
            i, j = i[near], j[near]
            met = (signs[i] == signs[j]).argmax(axis=1) == table[i]  # only in the first table where the pair meets
            i, j = i[met], j[met]
            np.add.at(weight, i, many[j])
            np.add.at(weight, j, many[i])
            if len(i):
                edges.append(smallest_reachable(ident[i], ident[j]))
        got = np.flatnonzero(weight)
        a = np.concatenate([ident[got], *[e[0] for e in edges]])
        b = np.concatenate([ident[got], *[e[1] for e in edges]])
        w = np.concatenate([weight[got], *[np.zeros(len(e[0]), np.int64) for e in edges]])
        keep = (w > 0) | (a != b)
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (a, b, w)], schema=schema)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = dict(zip(batch.schema.names, batch.columns))
            units = [np.frombuffer(x, "<f8") for x in column["unit"].to_pylist()]
            width = max(map(len, units))
            rows = [np.stack([column[k].to_numpy() for k in KEY], axis=1), *[column[k].to_numpy() for k in ("own", "id", "many")],
                    np.stack([np.frombuffer(x, "<u4") for x in column["signs"].to_pylist()]),
                    np.stack([np.pad(x, (0, width - len(x))) for x in units])]
            if held is not None:
                wide = max(width, held[5].shape[1])
                held[5], rows[5] = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (held[5], rows[5]))
                rows = [np.concatenate(x) for x in zip(held, rows)]
            other = np.flatnonzero((rows[0] != rows[0][-1]).any(axis=1))
            whole = int(other[-1]) + 1 if len(other) else 0  # the last group may go on in the next batch
            if whole:
                yield compare(*[x[:whole] for x in rows])
            held = [x[whole:] for x in rows]
        if held is not None:
            yield compare(*held)
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, bits: int = BITS, block: int = BLOCK,
                    seed: int = 11) -> DataFrame:
    """Near-duplicate groups of ``vectors`` (vec_id, label, embedding; other columns are not read).

    One row per input row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable by links, itself included), kept (vec_id = component_id).
    Null, empty and zero vectors, vectors with a null or non-finite component, and
    vectors without a label link with nothing; vectors of different length do not
    link.  A null vec_id links with nothing, counts for nobody, has a null component_id
    and is kept; a repeated vec_id is one vector per row, its rows sharing a component.
    An empty table gives an empty result.
    """
    signed = materialize(map_slices(vectors.select("vec_id", "label", "embedding"), _signing(tables, bits, seed),
                                    "vec_id long, label int, signs binary, unit binary", rows=1024), "signs")
    whole = signed.where("vec_id is not null and label is not null and unit is not null")
    # equal units are one class; the double-precision unit of equal vectors is equal
    classes = materialize(whole.groupBy("label", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("many"),
                                                             F.first("signs").alias("signs"))
                          .withColumn("dim", F.octet_length("unit")), "classes")
    sign = F.conv(F.hex(F.expr("substring(signs, 4 * table + 1, 4)")), 16, 10).cast("long").alias("sign")
    spots = (classes.select("id", "label", "dim", "signs", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("table"))
             .select("id", "label", "dim", "table", sign))
    bucket = ["label", "dim", "table", "sign"]
    crowded = spots.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    placed = (spots.join(crowded, bucket)
              .withColumn("blocks", F.ceil(F.col("n") / block))
              .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
              .select("id", *bucket, "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    fields = _parse_datatype_string("a long, b long, w long")
    ship_package(vectors.sparkSession)
    groups = (placed.join(classes.select("id", "label", "dim", "many", "signs", "unit"), ["id", "label", "dim"])
              .select(*[F.col(k).cast("long").alias(k) for k in KEY], "own", "id", "many", "signs", "unit")
              .repartition(*KEY).sortWithinPartitions(*KEY))
    found = materialize(groups.mapInArrow(_comparing(cosine, to_arrow_schema(fields)), fields), "links")
    counts = found.where("w > 0").groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("w"))
    reach = components(found.where("w = 0"), "a", "b")
    ends = (classes.join(counts, "id", "left").join(reach.withColumnRenamed("node", "id"), "id", "left")
            .select("label", "unit", (F.coalesce("w", F.lit(0)) + F.col("many") - 1).alias("n_links"),
                    F.coalesce("component", "id").alias("class_component")))
    return (signed.withColumn("known", F.expr("if(vec_id is null, null, unit)")).join(
        ends.withColumnRenamed("unit", "known"), ["label", "known"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("class_component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
