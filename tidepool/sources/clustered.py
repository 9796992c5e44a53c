"""Tables clustered by key (C8): range-partitioned sorted files with their checked key ranges beside them.

The files' names follow the order of their ranges.  ``_ranges`` (one row per file) tells
each file's smallest and largest key and its rows, so a lookup opens only the files that
can hold the key, and every row's place in the whole order is its file's offset plus its
place in the file: no global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


class NotClustered(Exception):
    """Raised when files' key ranges do not follow one another."""


def _order(df: DataFrame, key: str) -> list:
    """The key, then a hash of the whole row, so that one hot key is dealt over several files."""
    return [F.col(key), F.xxhash64(*sorted(df.columns))]


def write(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Write ``df`` sorted by ``key`` over ``files`` range partitions (default: the session's shuffle partitions,
    merged by AQE where small), then the files' ranges.  Null keys come first.  Refuses ranges that overlap."""
    order = _order(df, key)
    dealt = df.repartitionByRange(*([files] if files else []), *order)
    dealt.sortWithinPartitions(*order).write.parquet(path)
    found = (df.sparkSession.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(key).isNull()).alias("n_null")))
    found.coalesce(1).write.parquet(f"{path}/_ranges")
    check(ranges(df.sparkSession, path))


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """One row per file that holds rows: file, first, last, n_rows, n_null, and ``start``, the rows of the files before it."""
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # over files, not rows
    return spark.read.parquet(f"{path}/_ranges").withColumn("start", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))


def check(found: DataFrame) -> None:
    """Raise ``NotClustered`` if a file's smallest key lies below the largest one of a file before it."""
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    wrong = found.withColumn("reached", F.max("last").over(before)).where("first < reached").select("file").take(1)
    if wrong:
        raise NotClustered(f"{wrong[0]['file']} starts below the files before it")


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def between(spark: SparkSession, path: str, key: str, low, high) -> DataFrame:
    """Rows with ``low <= key <= high``, read from the files whose ranges meet it only; none for a null bound."""
    meets = (F.col("first") <= F.lit(high)) & (F.col("last") >= F.lit(low))
    files = [f"{path}/{r['file']}" for r in spark.read.parquet(f"{path}/_ranges").where(meets).select("file").collect()]
    table = scan(spark, path)
    if not files:
        return table.where(F.lit(False))
    return spark.read.schema(table.schema).parquet(*files).where(F.col(key).between(F.lit(low), F.lit(high)))


def positions(spark: SparkSession, path: str, key: str, out: str = "position") -> DataFrame:
    """All rows with their number (from 1) in the order of the table.  A window never spans more than one file."""
    table = scan(spark, path)
    starts = ranges(spark, path).select(F.col("file").alias("_file"), F.col("start").alias("_start"))  # a row per file
    within = F.row_number().over(W.partitionBy("_file").orderBy(*_order(table, key)))
    named = table.select(*table.columns, F.col("_metadata.file_name").alias("_file"))
    return named.withColumn(out, within).join(F.broadcast(starts), "_file") \
        .withColumn(out, (F.col(out) + F.col("_start")).cast("bigint")).drop("_file", "_start")
