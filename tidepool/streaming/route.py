"""Streaming contract route.

Source: a Kafka topic (``kafka_source``) or, where no Kafka connector is
installed, a file stream of the order table turned into the same
``(topic, partition, offset, value)`` shape (``order_file_source``).

Sink: ``foreachBatch`` validates each micro-batch once (persisted), appends
accepted rows to the valid table and rejects to the quarantine table; the rows
sent are counted by ``observe`` while they are written.  Offsets live in the query checkpoint, so a restarted query resumes exactly where it stopped; both
file sinks are idempotent per batch id (``txnVersion`` style: each batch
writes under its own ``batch_id`` partition and overwrites it on replay).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import contract as ct
from tidepool.plans.ingest import feed_from_orders
from tidepool.sources.tables import deal

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority"]


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic from the earliest offset (needs the Kafka connector on the classpath)."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic).option("startingOffsets", "earliest")
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def order_file_source(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """S1/S2 without a broker: the order table as a file stream, shaped like a topic."""
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_COLUMNS).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet") \
        .option("maxFilesPerTrigger", max_files_per_trigger).parquet(sf_dir)
    return feed_from_orders(stream.select(*ORDER_COLUMNS))


def _route_batch(valid_path: str, quarantine_path: str, counts_path: str | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        v = ct.validate(deal(batch)).persist()
        try:
            tag, counts = F.lit(batch_id).cast("bigint").alias("batch_id"), []
            for name, rows, path in (("valid", ct.accepted(v), valid_path), ("quarantine", ct.quarantined(v), quarantine_path)):
                seen = Observation(name)
                rows.select("*", tag).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
                    .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
                counts.append((name, seen.get["n"], batch_id))
        finally:
            v.unpersist()
        if counts_path:
            # the batch's own folder, written over by a replay
            batch.sparkSession.createDataFrame(counts, COUNTS).coalesce(1).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(counts_path)
    return run


COUNTS = "route string, n_rows bigint, batch_id bigint"


def start_route(source: DataFrame, valid_path: str, quarantine_path: str, checkpoint: str,
                available_now: bool = True, counts_path: str | None = None):
    """Start the routing query (``availableNow`` drains what is there and stops).  ``counts_path`` gets the rows
    sent to each route by batch, observed while they are written (V17, S4)."""
    w = source.writeStream.foreachBatch(_route_batch(valid_path, quarantine_path, counts_path)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def observed_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """``(route, n_rows)`` over all batches, from the observed counts: no sink is read."""
    return spark.read.schema(COUNTS).parquet(counts_path).groupBy("route").agg(F.sum("n_rows").alias("n_rows"))


def kafka_route_sink(validated: DataFrame, valid_topic: str, quarantine_topic: str) -> DataFrame:
    """S4/S5 for Kafka: one frame with a computed ``topic`` and JSON ``value`` column."""
    ok = F.size("errors") == 0
    fields = F.struct(*[F.col(n) for n, _ in ct.FIELDS])
    envelope = F.struct(F.col("value").alias("original_record"), "rejection_reason",
                        F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
                        F.col("offset").alias("source_offset"),
                        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
                        .alias("rejected_at"))
    return validated.select(F.when(ok, valid_topic).otherwise(quarantine_topic).alias("topic"),
                            F.when(ok, F.to_json(fields)).otherwise(F.to_json(envelope)).alias("value"))


def route_counts(spark: SparkSession, valid_path: str, quarantine_path: str) -> DataFrame:
    """V17 over the two sink tables: ``(route, n_rows)``, 0 for a table without rows."""
    def count(route, path):  # the batch id is all that is read; given as schema, an empty sink can be read too
        return spark.read.schema("batch_id bigint").parquet(path).agg(F.lit(route).alias("route"), F.count(F.lit(1)).alias("n_rows"))
    return count("valid", valid_path).unionByName(count("quarantine", quarantine_path))


def kafka_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                ending: str = "latest") -> DataFrame:
    """S3: read a topic back as a bounded batch between two offset specs."""
    return spark.read.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic).option("startingOffsets", starting).option("endingOffsets", ending) \
        .load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
