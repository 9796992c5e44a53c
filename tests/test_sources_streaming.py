"""Sources, sinks and streaming: keyed add, guarded scan, batch route = streaming route."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import contract as ct
from tidepool.plans import ingest
from tidepool.session import scratch_path
from tidepool.sources import tables
from tidepool.streaming import consume, route, topic, upsert

from conftest import SF001


def test_add_new_by_key(spark):
    path = scratch_path(spark, "keyed")
    a = spark.createDataFrame([("c1", "x"), ("c2", "y")], "chunk_id string, text string")
    assert tables.append_new_by_key(a, path, ["chunk_id"]) == 2
    b = spark.createDataFrame([("c2", "changed"), ("c3", "z")], "chunk_id string, text string")
    assert tables.append_new_by_key(b, path, ["chunk_id"]) == 1
    got = {r.chunk_id: r.text for r in spark.read.parquet(path).collect()}
    assert got == {"c1": "x", "c2": "y", "c3": "z"}


def test_guarded_scan(spark):
    with pytest.raises(tables.TableNotFound):
        tables.guarded_scan(spark, scratch_path(spark, "missing"))


def test_stream_route_equals_batch_route(spark):
    base = scratch_path(spark, "route-test")
    q = route.start_route(route.order_file_source(spark, SF001), f"{base}/v", f"{base}/q", f"{base}/ck")
    q.awaitTermination()
    got = {r.route: r.n_rows for r in route.route_counts(spark, f"{base}/v", f"{base}/q").collect()}
    s = ct.route_summary(ingest.validated(spark, SF001)).collect()[0]
    assert got == {"valid": s.accepted, "quarantine": s.quarantined}
    # a second run of the same query finds nothing new (offsets are in the checkpoint)
    q2 = route.start_route(route.order_file_source(spark, SF001), f"{base}/v", f"{base}/q", f"{base}/ck")
    q2.awaitTermination()
    again = {r.route: r.n_rows for r in route.route_counts(spark, f"{base}/v", f"{base}/q").collect()}
    assert again == got


def test_route_counts_of_empty_sinks(spark):
    base = scratch_path(spark, "empty-sinks")
    for name in ("v", "q"):
        spark.createDataFrame([], "order_id string, batch_id bigint").write.partitionBy("batch_id").parquet(f"{base}/{name}")
    assert {r.route: r.n_rows for r in route.route_counts(spark, f"{base}/v", f"{base}/q").collect()} == {"valid": 0, "quarantine": 0}


def test_stream_of_several_files_with_a_restart(spark, tmp_path):
    """Two files, one micro-batch each; a third file arrives before the query is started again."""
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select(*route.ORDER_COLUMNS)
    folder, base = tmp_path / "in", str(tmp_path)

    def add(part):
        orders.where(f"o_orderkey % 3 = {part}").coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        route.start_route(ingest.feed_from_orders(stream), f"{base}/v", f"{base}/q", f"{base}/ck").awaitTermination()
        return {r.route: r.n_rows for r in route.route_counts(spark, f"{base}/v", f"{base}/q").collect()}

    add(0)
    add(1)
    assert sum(run().values()) == orders.where("o_orderkey % 3 < 2").count()
    assert spark.read.parquet(f"{base}/v").select("batch_id").distinct().count() == 2
    add(2)
    whole = ct.route_summary(ct.validate(ingest.feed_from_orders(orders))).first()
    assert run() == {"valid": whole.accepted, "quarantine": whole.quarantined}


def test_observed_counts_equal_the_sinks(spark, tmp_path):
    """Counts taken while the sinks are written, over several batches and a restart, without reading a sink."""
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select(*route.ORDER_COLUMNS)
    folder, base = tmp_path / "in", str(tmp_path)

    def run():
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        route.start_route(ingest.feed_from_orders(stream), f"{base}/v", f"{base}/q", f"{base}/ck", counts_path=f"{base}/n").awaitTermination()
        sinks = {r.route: r.n_rows for r in route.route_counts(spark, f"{base}/v", f"{base}/q").collect()}
        assert {r.route: r.n_rows for r in route.observed_counts(spark, f"{base}/n").collect()} == sinks
        return sinks

    for part in (0, 1):
        orders.where(f"o_orderkey % 3 = {part}").coalesce(1).write.mode("append").parquet(str(folder))
    first = run()
    assert run() == first
    orders.where("o_orderkey % 3 = 2").coalesce(1).write.mode("append").parquet(str(folder))
    assert sum(run().values()) == orders.count()
    assert spark.read.parquet(f"{base}/n").select("batch_id").distinct().count() == 3


TOPIC = "topic string, partition int, offset long, value string"


def test_consume_stops_after_so_many_records(spark, tmp_path):
    rows = [("t", p, o, f"{p}-{o}") for p in range(3) for o in range(5)]
    topic.append(spark.createDataFrame(rows, TOPIC), f"{tmp_path}/topic", span=2)
    got = []

    def sink(batch, poll):
        got.append(sorted((r.offset, r.partition) for r in batch.collect()))

    def read():
        return topic.scan(spark, f"{tmp_path}/topic")

    first = consume.consume(read, f"{tmp_path}/group", sink, max_records=8, poll_records=5)
    assert first == 8 and [len(g) for g in got] == [5, 3] and sum(got, []) == sorted((o, p) for _, p, o, _ in rows)[:8]
    # the next consumer of the group goes on there, and stops when nothing comes any more
    assert consume.consume(read, f"{tmp_path}/group", sink, poll_records=100, idle_polls=2, wait=0) == 7
    assert sorted(sum(got, [])) == sorted((o, p) for _, p, o, _ in rows)
    topic.append(spark.createDataFrame([("t", 1, 9, "late"), ("t", 7, 0, "new partition")], TOPIC), f"{tmp_path}/topic", span=2)
    assert consume.consume(read, f"{tmp_path}/group", sink, poll_records=100, wait=0) == 2
    assert consume.committed(spark, f"{tmp_path}/group") == {0: 5, 1: 10, 2: 5, 7: 1}

    def fails(batch, poll):
        raise RuntimeError("sink lost")

    topic.append(spark.createDataFrame([("t", 0, 5, "again")], TOPIC), f"{tmp_path}/topic", span=2)
    with pytest.raises(RuntimeError):
        consume.consume(read, f"{tmp_path}/group", fails, wait=0)
    assert consume.consume(read, f"{tmp_path}/group", sink, wait=0) == 1 and got[-1] == [(5, 0)]  # not committed, so read again
    assert consume.consume(lambda: read().limit(0), f"{tmp_path}/other", sink, wait=0) == 0


def test_topic_between_offsets(spark, tmp_path):
    rows = [("t", p, o, "x") for p in range(2) for o in range(100) if not (p == 1 and 30 <= o < 33)]
    path = f"{tmp_path}/topic"
    topic.append(spark.createDataFrame(rows, TOPIC), path, span=10)
    part = topic.between(spark, path, {0: (15, 32), 1: (29, 34)})
    assert sorted((r.partition, r.offset) for r in part.collect()) == [(0, o) for o in range(15, 32)] + [(1, 29), (1, 33)]
    assert len(part.inputFiles()) >= 3 and "PartitionFilters: [" in part._jdf.queryExecution().toString()
    read = part.select(F.input_file_name().alias("f")).distinct().count()
    assert read <= 5  # of twenty spans
    assert sorted(tuple(r) for r in topic.gaps(part, {0: (15, 32), 1: (29, 34), 4: (0, 2)}).collect()) == [(1, 30, 33), (4, 0, 2)]
    assert topic.gaps(topic.scan(spark, path)).collect() == [(1, 30, 33)]
    assert topic.between(spark, path, {}).collect() == []


def test_kafka_sink_shape(spark):
    v = ct.validate(spark.createDataFrame(
        [("t", 0, 0, '{"order_id": 1}')], "topic string, partition int, offset bigint, value string"))
    out = route.kafka_route_sink(v, "valid", "quarantine").collect()[0]
    assert out.topic == "quarantine" and '"original_record"' in out.value


def test_stream_upsert_replay_is_idempotent(spark):
    from tidepool.operators.silver import merge_upsert
    from tidepool.plans import deliveries as dv
    from tidepool.sources.tables import driver_table
    base = scratch_path(spark, "upsert-test")
    upsert.init_table(dv.silver(spark, SF001), base, ["delivery_id"])
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    schema = driver_table(spark, SF001, "orders", *cols).schema

    def run():
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet") \
            .option("maxFilesPerTrigger", 1).parquet(SF001)
        b = dv.bronze_from(stream.select(*cols), dv.customer_zones(spark, SF001),
                           keep=("o_orderstatus", "o_orderpriority"))
        q = upsert.start_upsert(dv.updates_from(b), base, ["delivery_id"], f"{base}/_ck")
        q.awaitTermination()
        return sorted(map(tuple, upsert.current_version(spark, base).collect()))

    first = run()
    assert run() == first     # restarted query: offsets in the checkpoint, nothing applied twice
    want = merge_upsert(dv.silver(spark, SF001), dv.update_batch(spark, SF001), ["delivery_id"])
    assert first == sorted(map(tuple, want.collect()))


def test_upsert_writes_only_touched_buckets(spark, tmp_path):
    import os
    base, table = str(tmp_path / "t"), spark.range(400).selectExpr("concat('k', id) as k", "id as v").unionByName(
        spark.createDataFrame([(None, 7)], "k string, v long"))
    upsert.init_table(table, base, ["k"], buckets=8)

    def times():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{base}/data") for f in names if f.endswith(".parquet")}

    before = times()
    one = spark.createDataFrame([("k5", 1000)], "k string, v long")
    written = upsert.upsert(one, base, ["k"], 0)
    after = times()
    assert len(written) == 1 and all(after[f] == t for f, t in before.items())  # nothing old is touched
    assert {f.split("_bucket=")[1].split("/")[0] for f in after.keys() - before.keys()} == {str(written[0])}
    rows = {(r.k, r.v) for r in upsert.current_version(spark, base).collect()}
    assert len(rows) == 401 and ("k5", 1000) in rows and ("k5", 5) not in rows and (None, 7) in rows
    # a crash between the write and the manifest: the version is not there, and the replay gives it
    more = spark.createDataFrame([("k6", 2000), ("new", 1), (None, 8), (None, 8)], "k string, v long")
    commit, upsert._commit = upsert._commit, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            upsert.upsert(more, base, ["k"], 1)
    finally:
        upsert._commit = commit
    assert upsert.versions(spark, base) == [0, 1] and upsert.current_version(spark, base).count() == 401
    for _ in range(2):  # the replay of a replay changes nothing
        upsert.upsert(more, base, ["k"], 1)
        got = sorted((str(r.k), r.v) for r in upsert.current_version(spark, base).collect())
        assert len(got) == 404 and ("k6", 2000) in got and got.count(("None", 8)) == 2
    assert upsert.upsert(one.limit(0), base, ["k"], 2) == [] and upsert.current_version(spark, base).count() == 404
    assert upsert.current_version(spark, base, 0).where("k = 'k5' and v = 5").count() == 1
    assert upsert.retire(spark, base, keep=1) >= 2 and upsert.versions(spark, base) == [3]
    assert sorted((str(r.k), r.v) for r in upsert.current_version(spark, base).collect()) == got


def test_upsert_into_an_empty_table(spark, tmp_path):
    base = str(tmp_path / "t")
    upsert.init_table(spark.createDataFrame([], "k string, v long"), base, ["k"])
    assert upsert.current_version(spark, base).collect() == []
    upsert.upsert(spark.createDataFrame([("a", 1)], "k string, v long"), base, ["k"], 0)
    assert [tuple(r) for r in upsert.current_version(spark, base).collect()] == [("a", 1)]


def test_spread_follows_its_setting(spark):
    narrow = spark.range(100).coalesce(1)
    assert tables.spread(narrow).rdd.getNumPartitions() == 1
    spark.conf.set(tables.SPREAD, "3")
    try:
        assert tables.spread(narrow).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(tables.SPREAD)


def test_materialize_writes_under_checkpoint_dir(spark):
    from tidepool.session import checkpoint_root, materialize
    df = materialize(spark.range(10), "unit")
    assert df.count() == 10
    from urllib.parse import urlparse
    root = urlparse(checkpoint_root(spark)).path
    assert df.inputFiles() and all(urlparse(f).path.startswith(root + "/") for f in df.inputFiles())
