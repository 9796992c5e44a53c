"""A consumer group over a topic table that takes an exact number of records, and stops when none come.

Each poll admits the first ``poll_records`` records beyond the committed offsets, in order of
(offset, partition), fixes them as one offset range per partition, hands them to the sink
and then commits the ranges' ends.  A range may end inside a file or a span.  A sink that
fails leaves the offsets as they were, so its records are read again.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSETS = "partition int, next long, poll long"


def committed(spark: SparkSession, group_path: str) -> dict[int, int]:
    """The next offset of every partition that the group has read from."""
    return {p: n for p, n, _ in _ledger(spark, group_path)}


def _ledger(spark: SparkSession, group_path: str) -> list[tuple[int, int, int]]:
    try:
        rows = spark.read.schema(OFFSETS).parquet(f"{group_path}/poll=*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return []
        raise
    newest = rows.groupBy("partition").agg(F.max("next").alias("next"), F.max("poll").alias("poll"))
    return [tuple(r) for r in newest.collect()]  # a row per partition of the topic


def admit(records: DataFrame, offsets: dict[int, int], limit: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """The first ``limit`` records beyond the offsets, and their range per partition (first offset, offset after the last)."""
    known = F.lit(0).cast("long")
    for partition, after in offsets.items():
        known = F.when(F.col("partition") == partition, F.lit(after).cast("long")).otherwise(known)
    fresh = records.where(F.col("offset") >= known)
    # places only: the values are read once the ranges are known
    first = fresh.select("partition", "offset").orderBy("offset", "partition").limit(limit)
    ranges = {r["partition"]: (r["a"], r["b"] + 1) for r in first.groupBy("partition").agg(F.min("offset").alias("a"), F.max("offset").alias("b")).collect()}
    inside = F.lit(False)
    for partition, (start, end) in ranges.items():
        inside = inside | ((F.col("partition") == partition) & (F.col("offset") >= start) & (F.col("offset") < end))
    return records.where(inside), ranges


def consume(read: Callable[[], DataFrame], group_path: str, sink: Callable[[DataFrame, int], None], max_records: int | None = None,
            poll_records: int = 100_000, idle_polls: int = 1, wait: float = 1.0) -> int:
    """Consume until ``max_records`` were taken, exactly, or ``idle_polls`` polls in a row found nothing; returns how many.

    ``read()`` gives the topic's records as they are now: (partition, offset) is unique, other
    columns go to the sink, ``sink(records, poll)``.  Between idle polls it waits ``wait`` seconds.
    """
    spark, taken, idle = read().sparkSession, 0, 0
    poll = max((n for _, _, n in _ledger(spark, group_path)), default=-1)
    while idle < idle_polls and (max_records is None or taken < max_records):
        limit = poll_records if max_records is None else min(poll_records, max_records - taken)
        records, ranges = admit(read(), committed(spark, group_path), limit)
        if not ranges:
            idle += 1
            if idle < idle_polls:
                time.sleep(wait)
            continue
        poll, idle = poll + 1, 0
        sink(records, poll)
        taken += records.count()
        ends = [(p, end, poll) for p, (_, end) in ranges.items()]
        spark.createDataFrame(ends, OFFSETS).coalesce(1).write.mode("overwrite").parquet(f"{group_path}/poll={poll}")
    return taken
