"""A topic as a table: rows of (topic, partition, offset, value) in folders of offset spans, read back between offsets (S3).

A folder holds the offsets of one partition and one span, so a read between two offsets
lists and opens only the folders that the range meets.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COLUMNS = ["topic", "partition", "offset", "value"]
SCHEMA = "topic string, offset long, value string, partition int, span long, width long"
SPAN = 100_000  # offsets of a folder

Ranges = Mapping[int, tuple[int, int]]  # partition -> (first offset, offset after the last)


def append(rows: DataFrame, path: str, span: int = SPAN) -> None:
    """Append rows to the topic's table; a table is written with one ``span``."""
    placed = rows.select(*COLUMNS, F.expr(f"offset div {span}").alias("span"), F.lit(span).cast("long").alias("width"))
    placed.hint("rebalance", F.col("partition"), F.col("span")).write.mode("append").partitionBy("width", "partition", "span").parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The whole topic."""
    return _read(spark, path).select(*COLUMNS)


def between(spark: SparkSession, path: str, ranges: Ranges) -> DataFrame:
    """The rows whose offset is in their partition's range; other partitions are not read."""
    table = _read(spark, path)
    widths = [r[0] for r in table.select("width").distinct().collect()] if ranges else []  # folder names
    wanted = F.lit(False)
    for partition, (start, end) in ranges.items():
        for width in widths:
            folder = (F.col("width") == width) & (F.col("partition") == partition) & F.col("span").between(start // width, max(end - 1, start) // width)
            wanted = wanted | (folder & (F.col("offset") >= start) & (F.col("offset") < end))
    return table.where(wanted).select(*COLUMNS)


def gaps(rows: DataFrame, ranges: Ranges | None = None) -> DataFrame:
    """(partition, first, after): runs of offsets that are missing, within the ranges that were asked for or, without any,
    between each partition's first and last offset."""
    seen = rows.select("partition", "offset")
    if ranges is not None:
        # the offsets around a range stand for rows that are there
        edges = [(p, o) for p, (start, end) in ranges.items() for o in (start - 1, end)]
        seen = seen.unionByName(rows.sparkSession.createDataFrame(edges, "partition int, offset long"))
    after = F.lead("offset").over(Window.partitionBy("partition").orderBy("offset"))
    return (seen.withColumn("_next", after).where(F.col("_next") > F.col("offset") + 1)
            .select("partition", (F.col("offset") + 1).alias("first"), F.col("_next").alias("after")))
