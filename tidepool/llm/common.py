"""Shared pieces of the training-data operators: table reading, Arrow slices, bounded caches, prefix sums."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.session import BATCH_BYTES, materialize, ship_package, small_batches  # noqa: F401

WORD_SPACE = b" \t\n\x0b\x0c\r"  # the white space that ends a word; bytes.split() splits at exactly these


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MODELS: dict = {}  # what this Python worker has loaded
_TAKEN: set = set()  # which of it the task at hand has taken


def model(key, load: Callable):
    """``load()``, once per Python worker; kept from task to task until one begins that does not take it."""
    _TAKEN.add(key)
    if key not in _MODELS:
        _MODELS[key] = load()
    return _MODELS[key]


def begin(make: Callable) -> Callable:
    """The step of a task.  Models of other steps go: a worker serves every step of an application, and what each
    of them has loaded would otherwise lie beside the executor's heap to the end."""
    _TAKEN.clear()
    step = make()
    for key in _MODELS.keys() - _TAKEN:
        del _MODELS[key]
    return step


def map_slices(df: DataFrame, make: Callable, schema: str | T.StructType, rows: int = 256) -> DataFrame:
    """Run a step over small slices of each partition.

    ``make()`` is called once per task and returns ``step(columns)``, which takes
    a dict of Python lists (one slice) and returns a dict of output lists or
    arrays.  Slices bound the memory of a task whatever the partition's size.
    What ``make`` takes from ``model`` stays with the worker while its tasks take it.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)

    def run(batches):
        step, batch, part, out = begin(make), None, None, None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        del step, batch, part, out
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    return df.mapInArrow(run, fields)


class Memo(dict):
    """``fn(key)`` remembered per key; ``room()`` empties the memory once it holds ``limit`` keys."""

    def __init__(self, fn: Callable, limit: int = 100_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        self[key] = value = self.fn(key)
        return value

    def room(self) -> None:
        if len(self) > self.limit:
            self.clear()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, vectorised over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gather(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """Concatenate the pieces ``blob[offsets[i]:offsets[i + 1]]`` for every i of ``ids``."""
    if not len(ids):
        return b""
    lengths = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(lengths)
    where = np.repeat(offsets[ids] - (ends - lengths), lengths) + np.arange(int(ends[-1]))
    return blob[where].tobytes()


def offset_table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(blob, offsets) of a list of byte strings, as ``gather`` takes them."""
    offsets = np.zeros(len(pieces) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in pieces], out=offsets[1:])
    return np.frombuffer(b"".join(pieces), dtype=np.uint8), offsets


def running_start(df: DataFrame, order: list[str], size: str, name: str, files: int | None = None) -> DataFrame:
    """Add ``start``: the sum of ``size`` over all rows before this one in ``order``.

    Range-partitions the (narrow) frame, sums within each sorted partition, and
    adds the totals of the partitions before: one row per partition, at most
    ``spark.sql.shuffle.partitions`` of them.  ``order`` must end in a unique
    column, which also lets equal keys be cut at any row.  ``files``: see ``materialize``.
    """
    spark = df.sparkSession
    ship_package(spark)
    columns = df.columns
    fields = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())])
    arrow = to_arrow_schema(fields)

    def run(batches):
        total = 0
        for batch in batches:
            sizes = np.asarray(batch.column(columns.index(size)).to_numpy(zero_copy_only=False), dtype=np.int64)
            ends = np.cumsum(sizes)
            local = total + ends - sizes
            total += int(ends[-1]) if len(ends) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], schema=arrow)

    # numbered before the step: a task that writes several partitions into one file has one number for all of them
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    summed = materialize(ordered.mapInArrow(run, fields), name, files)
    totals = summed.groupBy("_part").agg(F.max(F.col("_local") + F.col(size)).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    return (summed.join(F.broadcast(before), "_part")
            .withColumn("start", F.col("_before") + F.col("_local")).drop("_part", "_local", "_before"))
