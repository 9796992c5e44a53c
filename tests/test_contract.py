"""The order-event contract: one message per kind of defect, coercions, bounds and ISO forms."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidepool.operators import contract as ct


def message(**over):
    """A valid message of a tea house, with fields replaced, or left out where the value is ``...``."""
    fields = {"order_id": "T-1", "customer_id": "guest-7", "restaurant_name": "Leaf", "customer_area": "Old Town", "order_total_sar": 12.5,
              "delivery_distance_km": 1.5, "estimated_delivery_minutes": 9, "status": "PREPARING", "event_ts": "2031-02-03T04:05:06Z"} | over
    return {k: v for k, v in fields.items() if v is not ...}


def checked(spark, *messages):
    rows = [("tea", 3, i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return ct.validate(spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string"))


def reasons(spark, *messages):
    return [r.rejection_reason for r in checked(spark, *messages).orderBy("offset").collect()]


STATUS = "status: Value error, status must be one of ['CANCELLED', 'CONFIRMED', 'DELIVERED', 'PICKED_UP', 'PREPARING']"
TOTAL = "order_total_sar: Value error, order_total_sar must be greater than 0 and at most 5000"
DISTANCE = "delivery_distance_km: Value error, delivery_distance_km must be greater than 0 and at most 50"
MINUTES = "estimated_delivery_minutes: Value error, estimated_delivery_minutes must be between 5 and 180"


@pytest.mark.parametrize("over,reason", [
    ({}, ""), ({"note": "extra fields are dropped"}, ""),
    ({"order_id": ""}, "order_id: Value error, field must not be empty"), ({"customer_area": "\t\n"}, "customer_area: Value error, field must not be empty"),
    ({"customer_id": ...}, "customer_id: Field required"), ({"customer_id": None}, "customer_id: Input should be a valid string"),
    ({"order_id": 5}, "order_id: Input should be a valid string"), ({"status": ["PREPARING"]}, "status: Input should be a valid string"),
    ({"order_total_sar": 0}, TOTAL), ({"order_total_sar": 5000}, ""), ({"order_total_sar": 5000.5}, TOTAL), ({"order_total_sar": True}, ""),
    ({"order_total_sar": " 1_000.5 "}, ""), ({"order_total_sar": "cheap"}, "order_total_sar: Input should be a valid number, unable to parse string as a number"),
    ({"order_total_sar": None}, "order_total_sar: Input should be a valid number"),
    ({"delivery_distance_km": 50}, ""), ({"delivery_distance_km": 50.1}, DISTANCE), ({"delivery_distance_km": "-3"}, DISTANCE),
    ({"estimated_delivery_minutes": 4}, MINUTES), ({"estimated_delivery_minutes": 5}, ""), ({"estimated_delivery_minutes": 180}, ""),
    ({"estimated_delivery_minutes": 181}, MINUTES), ({"estimated_delivery_minutes": "90.0"}, ""), ({"estimated_delivery_minutes": 90.0}, ""),
    ({"estimated_delivery_minutes": 9.5}, "estimated_delivery_minutes: Input should be a valid integer, got a number with a fractional part"),
    ({"estimated_delivery_minutes": "9.5"}, "estimated_delivery_minutes: Input should be a valid integer, unable to parse string as an integer"),
    ({"status": "\tpicked_up "}, ""), ({"status": "LOST"}, STATUS),
    ({"event_ts": "yesterday"}, "event_ts: Value error, event_ts must use a valid ISO-8601 format"),
    ({"status": "LOST", "order_total_sar": -2, "customer_area": ...}, f"customer_area: Field required; {TOTAL}; {STATUS}"),
])
def test_one_message(spark, over, reason):
    assert reasons(spark, message(**over)) == [reason]


def test_messages_that_are_no_objects(spark):
    not_object = ": Input should be a valid dictionary or instance of OrderEvent"
    assert reasons(spark, "[]", "7", "{", "") == [not_object, not_object, "value: invalid JSON", "value: invalid JSON"]


def test_the_last_of_two_equal_keys_counts(spark):
    text = json.dumps(message())[:-1] + ', "order_id": "T-2"}'
    assert [r.order_id for r in ct.accepted(checked(spark, text)).collect()] == ["T-2"]


def test_coerced_values(spark):
    row = ct.accepted(checked(spark, message(restaurant_name=" Leaf\t", status=" delivered", estimated_delivery_minutes="30.0", order_total_sar="1_0", delivery_distance_km=True))).collect()[0]
    assert (row.restaurant_name, row.status, row.estimated_delivery_minutes, row.order_total_sar, row.delivery_distance_km) == ("Leaf", "DELIVERED", 30, 10.0, 1.0)
    assert list(row.asDict()) == [n for n, _ in ct.FIELDS]


@pytest.mark.parametrize(("text", "reason"), [
    ("", "value: invalid JSON"), ('{"order_id": "T-1"', "value: invalid JSON"), ("tea", "value: invalid JSON"),
    ("null", ct.MSG_NOT_OBJECT), ("[{}]", ct.MSG_NOT_OBJECT), ("7", ct.MSG_NOT_OBJECT), ('"tea"', ct.MSG_NOT_OBJECT),
])
def test_messages_that_are_no_object(spark, text, reason):
    assert [r.rejection_reason for r in ct.quarantined(checked(spark, text)).collect()] == [reason]


def test_routes_every_message_once(spark):
    v = checked(spark, message(), message(order_id="T-9", status="LOST"), "nothing", message(order_id="T-3"))
    row = ct.route_summary(v).collect()[0]
    assert (row.produced, row.accepted, row.quarantined, row.all_rejects_have_reason) == (4, 2, 2, True)
    held = ct.quarantined(v)
    rows = held.withColumn("id", ct.original_order_id(held)).orderBy("source_offset").collect()
    assert [(r.source_topic, r.source_partition, r.source_offset, r.id) for r in rows] == [("tea", 3, 1, "T-9"), ("tea", 3, 2, None)]
    assert rows[1].original_record == "nothing" and all(r.rejected_at is not None for r in rows)


@pytest.mark.parametrize("text", [
    "2025-W53-1", "2020-W53-1", "2026W30-1", "2026-W301", "2026W301", "2026-W00", "2026-07-22T10:00:00+25:00", "0000-01-01", "2026-07-22T10:0000",
    "2026-07-22T1000:00", "2026-07-22T100000", "2026-07-22T10", "2026-02-29", "2024-02-29", "2026-07-22T24:00:00", "2026-07", "20260722", "2026-07-22T10:00+23:59:59",
    "2026-07-22T10:00+24:00", "2026-07-22T10:00+0100", "2026-07-22x10:00", "2026-07-22T", "2026-13-01", "", "Z", "2026-07-22T10:61", "2026-07-22T10:00:00,5", "9999-W52-5",
    "2026-07-22T10:26.5", "2026-07-22T10.5", "2026-07-22T10,5Z", "2026-07-22T1026,25+01", "2026-07-22T10.", "2026-07-22T10:26.", "2026-07-22T25.5", "2026-07-22T.5",
    "2026-07-22T10.5:26", "2026-07-22T10:26+01:30.5", "2026-07-22T10:60.5",
])
def test_iso_forms_as_python_takes_them(spark, text):
    try:
        datetime.fromisoformat(text.replace("Z", "+00:00"))
        want = True
    except ValueError:
        want = False
    assert spark.range(1).select(ct.iso_timestamp_ok(F.lit(text)).alias("ok")).first().ok == want


def test_rules_run_on_more_tasks_than_the_file_has_row_groups(spark, tmp_path):
    """One file of one row group is dealt evenly before the rules, and every order is counted."""
    from tidepool.plans import ingest
    orders = spark.range(400).selectExpr("id as o_orderkey", "id % 9 as o_custkey", "'F' as o_orderstatus", "cast(id as double) as o_totalprice",
                                         "timestamp'2024-01-05' as o_orderdate", "'1-URGENT' as o_orderpriority")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    checked = ingest.validated(spark, str(tmp_path))
    sizes = [len(p) for p in checked.select("offset").rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 400 / 8
    summary = ingest.q_route_summary(spark, str(tmp_path)).first()
    assert summary.produced == 400 == summary.accepted + summary.quarantined
