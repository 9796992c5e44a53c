"""Tables clustered by key: order, hot and null keys, files read by a lookup."""

import os

import pytest
from pyspark.sql import functions as F

from tidepool.sources import clustered


def places(rows):
    return [r.k for r in sorted(rows, key=lambda r: r.position)]


def test_order_over_many_files_with_a_hot_key_nulls_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 50).cast("int").alias("k"),
                                 (F.col("id") % 450).alias("v"))
    clustered.write(df, path, "k", files=6)
    rows = clustered.positions(spark, path, "k").collect()
    assert sorted(r.position for r in rows) == list(range(1, 901))
    want = sorted((r.k for r in df.collect()), key=lambda k: (k is not None, k or 0))
    assert places(rows) == want
    assert sorted((r.k or -1, r.v) for r in rows) == sorted((r.k or -1, r.v) for r in df.collect())
    hot = clustered.ranges(spark, path).where("first <= 7 and last >= 7").count()
    assert hot > 1  # a third of the rows have one key: no file holds them all


def test_a_lookup_reads_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select(F.format_string("K%04d", "id").alias("k"), F.col("id").alias("position"))
    clustered.write(df, path, "k", files=8)
    one = clustered.between(spark, path, "k", "K0500", "K0500")
    assert [r.position for r in one.collect()] == [500]
    assert len(one.inputFiles()) == 1 < len(clustered.scan(spark, path).inputFiles())
    assert clustered.between(spark, path, "k", "K0990", "L").count() == 10
    assert clustered.between(spark, path, "k", "A", "B").count() == 0
    assert clustered.between(spark, path, "k", None, "Z").count() == 0


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    clustered.write(spark.createDataFrame([], "k int, v int"), path, "k")
    assert clustered.positions(spark, path, "k").collect() == []
    assert clustered.between(spark, path, "k", 1, 2).collect() == []


def test_overlapping_files_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    clustered.write(spark.range(100).withColumnRenamed("id", "k"), path, "k", files=4)
    found = clustered.ranges(spark, path)
    clustered.check(found)
    with pytest.raises(clustered.NotClustered):
        clustered.check(found.withColumn("first", F.lit(0)))
    assert os.path.isdir(f"{path}/_ranges")
