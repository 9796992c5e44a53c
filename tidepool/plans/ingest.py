"""Ingest: a raw JSON order feed derived from ``orders``, the contract route and its SQL oracles.

Feed binding: one message per order, Kafka-shaped ``(topic, partition, offset,
value)`` with ``partition = o_orderkey % 8`` and ``offset = o_orderkey div 8``.
Orders with ``o_orderkey % 7`` in 1..6 each carry one defect kind, and those with
``o_orderkey % 11`` in 1..4 another: minutes, total or distance over their bounds, or
a number for a name.  So messages have none, one or two defects on every scale factor.
With ``o_orderkey % 13`` in 1..4 the whole message is broken: cut off, a list, ``null`` or
plain text.  ``o_orderkey % 17`` in 1..4 gives fractions of minutes and hours in the
timestamp, two of them wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.text import WS_CLASS
from tidepool.operators import contract as ct
from tidepool.sources.tables import deal, driver_table

RAW_TOPIC = "food_orders_raw"
N_PARTITIONS = 8


def _q(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def feed_from_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    c, m = k % 7, k % 11
    total = F.expr("cast(cast(o_totalprice as decimal(18,2)) / 100 as decimal(18,4))").cast("string")
    dist = F.expr("cast(cast(o_custkey % 500 as decimal(18,0)) / 10 as decimal(18,1))").cast("string")
    minutes = (F.lit(5) + k % 176).cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "DELIVERED") \
        .when(F.col("o_orderstatus") == "O", "PICKED_UP").otherwise("PREPARING")
    ts = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    total_j = F.when(m == 2, F.lit("9999.5")).when(c == 1, F.concat(F.lit("-"), total)).when(c == 4, F.lit('"free"')).otherwise(total)
    dist_j = F.when(m == 3, F.lit("75.5")).when(c == 6, F.concat(F.lit('" '), dist, F.lit(' "'))).otherwise(dist)
    min_j = F.when(m == 1, F.lit("181")).when(c == 5, F.concat(minutes, F.lit(".5"))) \
        .when(k % 14 == 0, F.concat(F.lit('"'), minutes, F.lit('.0"'))).otherwise(minutes)
    status_j = _q(F.when(c == 2, F.lit("ON_THE_MOON"))
                  .when(k % 14 == 0, F.concat(F.lit(" "), F.lower(status), F.lit(" ")))
                  .otherwise(status))
    rest_j = F.when(m == 4, F.lit("12")).otherwise(_q(
        F.when(c == 3, F.lit("   ")).otherwise(F.concat(F.lit("Kitchen "), F.substring("o_orderpriority", 3, 40)))))
    area_j = F.when(c == 5, F.lit("")).otherwise(F.concat(
        F.lit('"customer_area": "Area '), (F.col("o_custkey") % 10).cast("string"), F.lit('", ')))
    day, t = F.date_format("o_orderdate", "yyyy-MM-dd"), k % 17
    ts = F.when(t == 1, F.concat(day, F.lit("T10:26.5Z"))).when(t == 2, F.concat(day, F.lit("T10,5"))) \
        .when(t == 3, F.concat(day, F.lit("T10:26."))).when(t == 4, F.concat(day, F.lit("T25.5Z"))).otherwise(ts)
    ts_j = _q(F.when(c == 6, F.lit("2026-07")).otherwise(ts))
    promo = F.when(k % 14 == 0, F.lit(', "promo": "FREE5"')).otherwise(F.lit(""))
    value = F.concat(
        F.lit('{"order_id": "ORD-'), k.cast("string"),
        F.lit('", "customer_id": "CUS-'), F.col("o_custkey").cast("string"),
        F.lit('", "restaurant_name": '), rest_j, F.lit(", "), area_j,
        F.lit('"order_total_sar": '), total_j,
        F.lit(', "delivery_distance_km": '), dist_j,
        F.lit(', "estimated_delivery_minutes": '), min_j,
        F.lit(', "status": '), status_j,
        F.lit(', "event_ts": '), ts_j, promo, F.lit("}"))
    w = k % 13
    ends = [F.when(w == 2, F.lit(mark)).otherwise(F.lit("")) for mark in "[]"]
    value = F.when(w == 1, F.concat(F.lit('{"order_id": "ORD-'), k.cast("string"))).when(w == 3, F.lit("null")) \
        .when(w == 4, F.concat(F.lit("order "), k.cast("string"))).otherwise(F.concat(ends[0], value, ends[1]))
    return orders.select(
        F.lit(RAW_TOPIC).alias("topic"),
        (k % N_PARTITIONS).cast("int").alias("partition"),
        F.expr(f"o_orderkey div {N_PARTITIONS}").alias("offset"),
        value.alias("value"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                        "o_orderpriority")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_from_orders(orders(spark, sf_dir))


def dealt_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed for the contract's rules, of about 0.1 ms a message: orders are dealt evenly first, narrower than their messages."""
    return feed_from_orders(deal(orders(spark, sf_dir)))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.validate(dealt_feed(spark, sf_dir))


def q_contract_valid(spark, sf):
    return ct.accepted(ct.route(dealt_feed(spark, sf)))


def q_contract_quarantine(spark, sf):
    return ct.quarantined(ct.route(dealt_feed(spark, sf)), with_time=False)


def q_contract_reasons(spark, sf):
    return ct.quarantined(ct.route(dealt_feed(spark, sf)), with_time=False) \
        .groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def q_route_summary(spark, sf):
    return ct.route_summary(validated(spark, sf))


def q_quarantine_order_ids(spark, sf):
    q = ct.quarantined(ct.route(dealt_feed(spark, sf)), with_time=False)
    return q.select(ct.original_order_id(q).alias("order_id"), "source_partition", "source_offset")


def q_json_props(spark, sf):
    ev = driver_table(spark, sf, "events", "event_id", "event_type", "props")
    return ev.select("event_id", "event_type",
                     F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("prop_k"))


QUERIES = {
    "contract_valid": q_contract_valid,
    "contract_quarantine": q_contract_quarantine,
    "contract_reasons": q_contract_reasons,
    "route_summary": q_route_summary,
    "quarantine_order_ids": q_quarantine_order_ids,
    "json_props": q_json_props,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_FEED = r"""
o AS (
  SELECT *, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 100 AS DECIMAL(18,4)) AS VARCHAR) AS total,
         CAST(CAST(CAST(o_custkey % 500 AS DECIMAL(18,0)) / 10 AS DECIMAL(18,1)) AS VARCHAR) AS dist,
         CAST(5 + o_orderkey % 176 AS VARCHAR) AS minutes,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PICKED_UP' ELSE 'PREPARING' END AS st,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ts, o_orderkey % 7 AS c, o_orderkey % 11 AS m,
         strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 17 AS t
  FROM orders),
whole AS (
  SELECT 'food_orders_raw' AS topic, CAST(o_orderkey % 8 AS INTEGER) AS "partition",
         o_orderkey // 8 AS "offset", o_orderkey AS k,
         '{"order_id": "ORD-' || CAST(o_orderkey AS VARCHAR) || '", "customer_id": "CUS-' ||
         CAST(o_custkey AS VARCHAR) || '", "restaurant_name": ' ||
         CASE WHEN m = 4 THEN '12' WHEN c = 3 THEN '"   "' ELSE '"Kitchen ' || substr(o_orderpriority, 3, 40) || '"' END || ', ' ||
         CASE WHEN c = 5 THEN '' ELSE '"customer_area": "Area ' || CAST(o_custkey % 10 AS VARCHAR) || '", ' END ||
         '"order_total_sar": ' ||
         CASE WHEN m = 2 THEN '9999.5' WHEN c = 1 THEN '-' || total WHEN c = 4 THEN '"free"' ELSE total END ||
         ', "delivery_distance_km": ' || CASE WHEN m = 3 THEN '75.5' WHEN c = 6 THEN '" ' || dist || ' "' ELSE dist END ||
         ', "estimated_delivery_minutes": ' ||
         CASE WHEN m = 1 THEN '181' WHEN c = 5 THEN minutes || '.5' WHEN o_orderkey % 14 = 0 THEN '"' || minutes || '.0"' ELSE minutes END ||
         ', "status": "' ||
         CASE WHEN c = 2 THEN 'ON_THE_MOON' WHEN o_orderkey % 14 = 0 THEN ' ' || lower(st) || ' ' ELSE st END ||
         '", "event_ts": "' || CASE WHEN c = 6 THEN '2026-07' WHEN t = 1 THEN day || 'T10:26.5Z' WHEN t = 2 THEN day || 'T10,5'
           WHEN t = 3 THEN day || 'T10:26.' WHEN t = 4 THEN day || 'T25.5Z' ELSE ts END || '"' ||
         CASE WHEN o_orderkey % 14 = 0 THEN ', "promo": "FREE5"' ELSE '' END || '}' AS message
  FROM o),
feed AS (
  SELECT topic, "partition", "offset",
         CASE k % 13 WHEN 1 THEN '{"order_id": "ORD-' || k WHEN 2 THEN '[' || message || ']' WHEN 3 THEN 'null'
              WHEN 4 THEN 'order ' || k ELSE message END AS value
  FROM whole)
"""


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def _field_sql() -> tuple[str, list[str], dict[str, str]]:
    """Per-field (type, text) columns, error expressions and coerced values."""
    cols, errs, vals = [], [], {}
    for name, kind in ct.FIELDS:
        t, s = f"t_{name}", f"s_{name}"
        cols.append(f"json_type(j, '$.{name}') AS {t}, json_extract_string(j, '$.{name}') AS {s}")
        req = f"WHEN {t} IS NULL THEN '{name}: {ct.MSG_REQUIRED}'"
        if kind in ("text", "status", "timestamp"):
            notstr = f"WHEN {t} <> 'VARCHAR' THEN '{name}: {ct.MSG_STRING}'"
            if kind == "text":
                vals[name] = _strip(s)
                rule = f"WHEN {vals[name]} = '' THEN '{name}: {ct.MSG_EMPTY}'"
            elif kind == "status":
                vals[name] = f"upper({_strip(s)})"
                allowed = ", ".join(f"'{a}'" for a in ct.ALLOWED_STATUSES)
                msg = (f"{name}: {ct.MSG_STATUS}").replace("'", "''")
                rule = f"WHEN {vals[name]} NOT IN ({allowed}) THEN '{msg}'"
            else:
                vals[name] = s
                # the forms that the feed has, told without the contract's own pattern
                # a date, then hours with optional minutes and seconds, a fraction of the last of them, and Z or nothing
                shape = r"\d{4}-\d{2}-\d{2}T[012]\d(:[0-5]\d){0,2}([.,]\d+)?Z?"
                ok = (f"coalesce(regexp_full_match({s}, '{shape}') AND TRY_CAST(substr({s}, 1, 10) AS DATE) IS NOT NULL "
                      f"AND substr({s}, 12, 2) < '24', false)")
                rule = f"WHEN NOT {ok} THEN '{name}: {ct.MSG_TS}'"
            errs.append(f"CASE {req} {notstr} {rule} END")
        elif kind == "float":
            txt = f"regexp_replace({_strip(s)}, '(\\d)_(\\d)', '\\1\\2', 'g')"
            parsed = f"CASE WHEN regexp_matches(lower({txt}), '{ct._NUM_TEXT}') THEN TRY_CAST({txt} AS DOUBLE) END"
            val = (f"(CASE WHEN {t} = 'VARCHAR' THEN {parsed} WHEN {t} = 'BOOLEAN' THEN "
                   f"CASE WHEN {s} = 'true' THEN 1.0 ELSE 0.0 END "
                   f"WHEN {t} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST({s} AS DOUBLE) END)")
            vals[name] = val
            hi, msg = (5000, ct.MSG_TOTAL) if name == "order_total_sar" else (50, ct.MSG_DISTANCE)
            errs.append(f"CASE {req} WHEN {t} = 'VARCHAR' AND {parsed} IS NULL THEN '{name}: {ct.MSG_NUMBER_PARSE}' "
                        f"WHEN {val} IS NULL THEN '{name}: {ct.MSG_NUMBER}' "
                        f"WHEN NOT ({val} > 0 AND {val} <= {hi}) THEN '{name}: {msg}' END")
        else:
            txt = f"regexp_replace({_strip(s)}, '(\\d)_(\\d)', '\\1\\2', 'g')"
            text_ok = f"regexp_matches({txt}, '{ct._INT_TEXT}')"
            dec = f"TRY_CAST({s} AS DECIMAL(38,6))"
            whole = f"({t} IN ('UBIGINT', 'BIGINT', 'BOOLEAN') OR ({dec} IS NOT NULL AND {dec} = floor({dec})))"
            val = (f"(CASE WHEN {t} = 'VARCHAR' THEN CASE WHEN {text_ok} THEN "
                   f"TRY_CAST(regexp_replace({txt}, '\\..*$', '') AS INTEGER) END "
                   f"WHEN {t} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND {whole} THEN TRY_CAST({dec} AS INTEGER) "
                   f"WHEN {t} = 'BOOLEAN' THEN CASE WHEN {s} = 'true' THEN 1 ELSE 0 END END)")
            vals[name] = val
            errs.append(f"CASE {req} WHEN {t} = 'VARCHAR' AND NOT {text_ok} THEN '{name}: {ct.MSG_INT_PARSE}' "
                        f"WHEN {t} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND NOT {whole} THEN '{name}: {ct.MSG_INT_FRACTION}' "
                        f"WHEN {val} IS NULL THEN '{name}: {ct.MSG_INT}' "
                        f"WHEN NOT ({val} BETWEEN 5 AND 180) THEN '{name}: {ct.MSG_MINUTES}' END")
    return ",\n  ".join(cols), errs, vals


def _validated_sql() -> str:
    cols, errs, vals = _field_sql()
    coerced = ",\n  ".join(
        f"CAST({vals[n]} AS {'DOUBLE' if k == 'float' else 'INTEGER' if k == 'int' else 'VARCHAR'}) AS {n}"
        for n, k in ct.FIELDS)
    reason = (f"CASE WHEN j IS NULL THEN '{ct.MSG_BAD_JSON}' WHEN json_type(j) <> 'OBJECT' THEN '{ct.MSG_NOT_OBJECT}' "
              "ELSE concat_ws('; ', " + ", ".join(errs) + ") END")
    return _FEED.strip() + f""",
parsed AS (SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM feed),
typed AS (SELECT *, {cols} FROM parsed),
validated AS (SELECT topic, "partition", "offset", value, j, {coerced},
  {reason} AS rejection_reason FROM typed)
"""


_V = "WITH " + _validated_sql()
_FIELD_LIST = ", ".join(n for n, _ in ct.FIELDS)

ORACLE = {
    "contract_valid": _V + f"SELECT {_FIELD_LIST} FROM validated WHERE rejection_reason = ''",
    "contract_quarantine": _V + """SELECT value AS original_record, rejection_reason, topic AS source_topic,
  "partition" AS source_partition, "offset" AS source_offset FROM validated WHERE rejection_reason <> ''""",
    "contract_reasons": _V + """SELECT rejection_reason, count(*) AS n_rows FROM validated
  WHERE rejection_reason <> '' GROUP BY rejection_reason""",
    "route_summary": _V + """SELECT count(*) AS produced, CAST(count_if(rejection_reason = '') AS BIGINT) AS accepted,
  CAST(count_if(rejection_reason <> '') AS BIGINT) AS quarantined,
  coalesce(bool_and(CASE WHEN rejection_reason <> '' THEN rejection_reason <> '' END), true)
    AS all_rejects_have_reason FROM validated""",
    "quarantine_order_ids": _V + """SELECT json_extract_string(j, '$.order_id') AS order_id,
  "partition" AS source_partition, "offset" AS source_offset FROM validated WHERE rejection_reason <> ''""",
    "json_props": "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k FROM events",
}


def q_stream_route_counts(spark, sf):
    """The route as a Structured Streaming query over the order table, drained
    with ``availableNow``; the rows sent are observed while the sinks are written."""
    from tidepool.session import scratch_path
    from tidepool.streaming.route import observed_counts, order_file_source, start_route
    base = scratch_path(spark, "stream-route")
    q = start_route(order_file_source(spark, sf), f"{base}/valid", f"{base}/quarantine", f"{base}/_checkpoint", counts_path=f"{base}/counts")
    q.awaitTermination()
    return observed_counts(spark, f"{base}/counts")


POLL = 1_000_000


def q_consume_polls(spark, sf):
    """A consumer group drains the feed in polls of exactly ``POLL`` records (the last one fewer); what each took."""
    from tidepool.session import scratch_path
    from tidepool.streaming import consume, topic
    base = scratch_path(spark, "consume")
    topic.append(raw_feed(spark, sf), f"{base}/topic")

    def sink(records, poll):
        records.groupBy("partition").agg(F.count(F.lit(1)).alias("n_records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")) \
            .write.mode("overwrite").parquet(f"{base}/sink/poll={poll}")

    n = spark.read.parquet(f"{base}/topic").count()
    consume.consume(lambda: topic.scan(spark, f"{base}/topic"), f"{base}/group", sink, poll_records=min(POLL, -(-n // 3)), wait=0)
    return spark.read.parquet(f"{base}/sink").select("poll", "partition", "n_records", "first_offset", "last_offset")


def q_topic_gaps(spark, sf):
    """S3: a topic without the orders in process, read back from offset 100 on up to the feed's last; the offsets that are missing."""
    from tidepool.session import scratch_path
    from tidepool.streaming import topic
    path = scratch_path(spark, "topic")
    topic.append(feed_from_orders(orders(spark, sf).where("o_orderstatus <> 'P'")), path)
    ends = {r["partition"]: (100, r["last"] + 1) for r in raw_feed(spark, sf).groupBy("partition").agg(F.max("offset").alias("last")).collect()}
    return topic.gaps(topic.between(spark, path, ends), ends)


QUERIES["consume_polls"] = q_consume_polls
QUERIES["topic_gaps"] = q_topic_gaps
_TOPIC = f"WITH feed AS (SELECT o_orderkey % {N_PARTITIONS} AS p, o_orderkey // {N_PARTITIONS} AS o FROM orders)"
ORACLE["consume_polls"] = _TOPIC + f"""
SELECT poll::INT AS poll, p::INT AS partition, count(*) AS n_records, min(o) AS first_offset, max(o) AS last_offset FROM (
  SELECT *, (row_number() OVER (ORDER BY o, p) - 1) // least({POLL}, (count(*) OVER () + 2) // 3) AS poll FROM feed)
GROUP BY poll, p"""
ORACLE["topic_gaps"] = _TOPIC + """,
there AS (SELECT o_orderkey % 8 AS p, o_orderkey // 8 AS o FROM orders WHERE o_orderstatus <> 'P'),
edges AS (SELECT p, o FROM there WHERE o >= 100 UNION ALL SELECT DISTINCT p, 99 FROM feed UNION ALL SELECT p, max(o) + 1 FROM feed GROUP BY p)
SELECT p::INT AS partition, o + 1 AS first, n AS after FROM (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS n FROM edges) WHERE n > o + 1"""
QUERIES["stream_route_counts"] = q_stream_route_counts
ORACLE["stream_route_counts"] = _V + """SELECT 'valid' AS route, CAST(count_if(rejection_reason = '') AS BIGINT) AS n_rows
FROM validated UNION ALL SELECT 'quarantine', CAST(count_if(rejection_reason <> '') AS BIGINT) FROM validated"""
