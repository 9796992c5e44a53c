"""Streaming keyed upsert (C6 per micro-batch), copying on write by buckets of the key.

The table is cut into buckets by a hash of its key.  Each micro-batch is merged into the
buckets that hold its keys, which are written anew as the version ``batch_id + 1``; a
manifest written last names the folder of every bucket, so that untouched ones stay
where they are.  Of several rows for one key of the table the latest counts.  A batch
replayed after a failure reads the same input version and overwrites its own output, so
the sink is idempotent; nothing is overwritten while it is being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.silver import check_merge, merge_conflicts, merge_upsert


def settle(batch: DataFrame, current: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """The batch with one row, the latest by ``order_col``, per key that it has several times and the table has too.

    Every other row stays: null keys and duplicates of new keys are all inserted (C6a).
    Without ``order_col`` there is no latest row, and such a key stops the batch.
    Rows of one time are ordered by their values, so a replay settles alike.
    """
    keys = list(keys)
    if order_col is None:
        check_merge(current, batch, keys)
        return batch
    several = merge_conflicts(current, batch, keys).select(*keys)
    latest = (batch.join(several, keys, "left_semi").groupBy(*keys)
              .agg(F.max(F.struct(F.col(order_col).alias("_order"), F.struct(*batch.columns).alias("_row"))).alias("_last")).select("_last._row.*"))
    return batch.join(several, keys, "left_anti").unionByName(latest)


BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key; rows with a null key, which never match, are in bucket -1."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return F.when(whole, F.pmod(F.xxhash64(*keys), F.lit(buckets))).otherwise(F.lit(-1)).cast("int")


def _write_buckets(rows: DataFrame, base: str, version: int, keys: Sequence[str], buckets: int) -> list[int]:
    """Write rows as a version's bucket folders; returns the buckets."""
    path = f"{base}/data/v={version}"
    placed = rows.withColumn("_bucket", bucket_of(keys, buckets)).hint("rebalance", F.col("_bucket"))  # a large bucket becomes several files
    placed.write.mode("overwrite").partitionBy("_bucket").parquet(path)
    try:
        written = rows.sparkSession.read.parquet(path).select("_bucket").distinct()  # folder names only
    except AnalysisException:  # no row, no folder
        return []
    return [r[0] for r in written.collect()]


def _commit(spark: SparkSession, base: str, version: int, rows: list[tuple]) -> None:
    """Write a version's manifest: which folder holds which bucket.  A version counts once this is written."""
    listed = spark.createDataFrame(rows, "bucket int, folder string, buckets int")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/v={version}")


def _manifest(spark: SparkSession, base: str, version: int) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{base}/manifest/v={version}").collect()]  # a row per bucket, and per batch with null keys


def _load(spark: SparkSession, base: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in folders])


def _schema(spark: SparkSession, base: str) -> T.StructType:
    return spark.read.parquet(f"{base}/schema").schema


def init_table(df: DataFrame, base: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write the initial table, version 0, in buckets of its key."""
    spark = df.sparkSession
    df.limit(0).write.mode("overwrite").parquet(f"{base}/schema")
    held = _write_buckets(df, base, 0, keys, buckets)
    _commit(spark, base, 0, [(b, f"data/v=0/_bucket={b}", buckets) for b in held] or [(-1, None, buckets)])


def _upsert_batch(base: str, keys: Sequence[str], order_col: str | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, base, keys, batch_id, order_col)
    return run


def upsert(batch: DataFrame, base: str, keys: Sequence[str], version: int, order_col: str | None = None) -> list[int]:
    """Merge a batch into a version of the table, giving the next one; returns the buckets rewritten.

    Only buckets that hold a key of the batch are read and written anew; the next
    version's manifest keeps the folders of the others.  Rows with a null key match
    nothing and are only added.
    """
    spark, keys = batch.sparkSession, list(keys)
    schema, before = _schema(spark, base), _manifest(spark, base, version)
    buckets = before[0][2]
    batch = batch.select(*schema.names).persist()
    try:
        touched = {r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect()}  # at most one more than buckets
        folders = [f for b, f, _ in before if f and b in touched and b >= 0]
        current = _load(spark, base, folders, schema)
        source = settle(batch, current, keys, order_col).select(*schema.names)
        merged = merge_upsert(current, source, keys)
        written = _write_buckets(merged, base, version + 1, keys, buckets) if touched else []
    finally:
        batch.unpersist()
    kept = [row for row in before if row[1] and (row[0] == -1 or row[0] not in touched)]
    new = [(b, f"data/v={version + 1}/_bucket={b}", buckets) for b in written]
    _commit(spark, base, version + 1, kept + new or [(-1, None, buckets)])
    return written


def start_upsert(source: DataFrame, base: str, keys: Sequence[str], checkpoint: str,
                 order_col: str | None = None, available_now: bool = True):
    w = source.writeStream.foreachBatch(_upsert_batch(base, keys, order_col)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def versions(spark: SparkSession, base: str) -> list[int]:
    """The versions whose manifest is written, oldest first; one cut short by a failure is not among them."""
    found = spark.read.option("basePath", f"{base}/manifest").parquet(f"{base}/manifest/v=*").select("v").distinct()
    return sorted(r[0] for r in found.collect())


def current_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The newest version, or an older one that is still kept."""
    version = versions(spark, base)[-1] if version is None else version
    return _load(spark, base, [f for _, f, _ in _manifest(spark, base, version) if f], _schema(spark, base))


def retire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Retention: delete the manifests before the last ``keep`` versions and the bucket folders only they name; returns how many folders."""
    known = versions(spark, base)
    old, new = known[:-keep], known[-keep:]
    needed = {f for v in new for _, f, _ in _manifest(spark, base, v)}
    unneeded = {f for v in old for _, f, _ in _manifest(spark, base, v)} - needed - {None}
    hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for folder in [*sorted(unneeded), *[f"manifest/v={v}" for v in old]]:
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/{folder}")
        path.getFileSystem(hadoop).delete(path, True)
    return len(unneeded)
