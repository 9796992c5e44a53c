"""Registered lakehouse queries (Silver, upsert, Gold, quality) and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import gold, quality, silver as sv
from tidepool.plans import deliveries as dv
from tidepool.schemas import DELIVERY_SCHEMA
from tidepool.session import materialize, scratch_path
from tidepool.sources import clustered
from tidepool.sources.tables import driver_table, guarded_scan, write_append, write_overwrite

KEY = ["delivery_id"]


def q_silver_standardise(spark, sf):
    return dv.silver(spark, sf)


def q_union_by_name(spark, sf):
    return sv.union_by_name(dv.silver(spark, sf), dv.bad_rows(spark, sf))


def q_merge_upsert(spark, sf):
    return sv.merge_upsert(dv.silver(spark, sf), dv.update_batch(spark, sf), KEY)


def q_merge_actions(spark, sf):
    return sv.merge_actions(dv.silver(spark, sf), dv.update_batch(spark, sf), KEY)


def q_merge_conflicts(spark, sf):
    return sv.merge_conflicts(dv.silver(spark, sf), dv.line_updates(spark, sf), KEY)


def q_schema_append(spark, sf):
    target = dv.silver(spark, sf)
    return target.unionByName(sv.conform_to_schema(dv.late_batch(spark, sf), DELIVERY_SCHEMA))


def q_schema_check(spark, sf):
    """C7 as data: for each schema issue of the rated batch, how many rows carry it."""
    batch = dv.rated_batch(spark, sf)
    issues = sv.schema_issues(batch.schema, DELIVERY_SCHEMA)
    parts = [batch.agg(F.lit(c).alias("column_name"), F.lit(i).alias("issue"),
                       F.count(F.col(c)).alias("n_rows")) for c, i in issues]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_corrupt_rows(spark, sf):
    """Q12: the failing batch itself (first three keys corrupted)."""
    return quality.corrupt_first_rows(dv.silver(spark, sf))


def q_gold_zone(spark, sf):
    return gold.zone_metrics(dv.silver(spark, sf), with_completed=False)


def q_gold_completed(spark, sf):
    return gold.zone_metrics(dv.silver(spark, sf), with_completed=True)


def q_gold_after_merge(spark, sf):
    return gold.zone_metrics(q_merge_upsert(spark, sf), with_completed=True)


def q_table_count(spark, sf):
    return gold.row_count(q_merge_upsert(spark, sf))


def _rule_query(kind):
    def run(spark, sf):
        rules = [r for r in quality.SILVER_FULL + quality.SILVER_MIN if r.kind == kind]
        return quality.run_suite(dv.silver(spark, sf), rules)
    return run


def q_dq_suite(spark, sf):
    return quality.run_suite(dv.silver(spark, sf), quality.SILVER_FULL)


def q_dq_failed_list(spark, sf):
    bad = sv.union_by_name(dv.silver(spark, sf), dv.bad_rows(spark, sf))
    return quality.failed_rules(quality.run_suite(bad, quality.SILVER_MIN)).select("n_failed", "detail")


def q_gated_gold(spark, sf):
    s = materialize(dv.silver(spark, sf), "silver")  # the very table that passes the gate feeds Gold
    quality.enforce(quality.run_suite(s, quality.SILVER_MIN))
    return gold.zone_metrics(s, with_completed=False)


def _faulty(spark, sf):
    """Silver with bad rows, and the slow deliveries twice."""
    s = dv.silver(spark, sf)
    return sv.union_by_name(sv.union_by_name(s, dv.bad_rows(spark, sf)), s.where("delivery_minutes > 100"))


def q_dq_faulty(spark, sf):
    """Both suites over a table that breaks several rules, among them uniqueness."""
    return quality.run_suite(_faulty(spark, sf), quality.SILVER_FULL + quality.SILVER_MIN)


def q_table_append(spark, sf):
    """Overwrite, a refused append, an append that fits, and the guarded read back."""
    path = scratch_path(spark, "append")
    write_overwrite(dv.silver(spark, sf), path)
    try:
        write_append(dv.rated_batch(spark, sf), path)
    except sv.SchemaMismatch:
        write_append(dv.late_batch(spark, sf), path)
    return guarded_scan(spark, path)


def q_sorted_silver(spark, sf):
    """Silver, range-partitioned and sorted by key."""
    return sv.sort_by_key(dv.silver(spark, sf), *KEY)


def q_clustered_silver(spark, sf):
    """Silver written in files clustered by key, read back with every row's place in the order."""
    path = scratch_path(spark, "clustered")
    clustered.write(dv.silver(spark, sf), path, KEY[0])
    return clustered.positions(spark, path, KEY[0])


def q_corrupt_suite(spark, sf):
    return quality.run_suite(quality.corrupt_first_rows(dv.silver(spark, sf)), quality.SILVER_FULL)


def q_stream_upsert(spark, sf):
    """The MERGE as a stream: order file stream -> Bronze (stream-static join) ->
    update rows -> foreachBatch upsert into versioned Silver."""
    from tidepool.streaming import upsert as su
    base = scratch_path(spark, "stream-upsert")
    su.init_table(dv.silver(spark, sf), base, KEY)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    schema = driver_table(spark, sf, "orders", *cols).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet") \
        .option("maxFilesPerTrigger", 1).parquet(sf)
    b = dv.bronze_from(stream.select(*cols), dv.customer_zones(spark, sf),
                       keep=("o_orderstatus", "o_orderpriority"))
    # rows without a key, and several rows for one new key: all of them are inserted
    extra = b.where("o_orderpriority = '5-LOW'").select(*[
        F.expr("if(delivery_minutes % 2 = 0, null, concat('NEW', customer_id))").alias("delivery_id") if f.name == "delivery_id" else f.name
        for f in DELIVERY_SCHEMA.fields])
    q = su.start_upsert(dv.updates_from(b).unionByName(extra), base, KEY, f"{base}/_checkpoint")
    q.awaitTermination()
    return su.current_version(spark, base).select(*[f.name for f in DELIVERY_SCHEMA.fields])


QUERIES = {
    "stream_upsert": q_stream_upsert,
    "silver_standardise": q_silver_standardise,
    "union_by_name": q_union_by_name,
    "merge_upsert": q_merge_upsert,
    "merge_actions": q_merge_actions,
    "merge_conflicts": q_merge_conflicts,
    "schema_append": q_schema_append,
    "schema_check": q_schema_check,
    "corrupt_rows": q_corrupt_rows,
    "gold_zone": q_gold_zone,
    "gold_completed": q_gold_completed,
    "gold_after_merge": q_gold_after_merge,
    "table_count": q_table_count,
    "dq_not_null": _rule_query("not_null"),
    "dq_unique": _rule_query("unique"),
    "dq_between": _rule_query("min"),
    "dq_in_set": _rule_query("in_set"),
    "dq_length": _rule_query("min_length"),
    "dq_suite": q_dq_suite,
    "dq_failed_list": q_dq_failed_list,
    "gated_gold": q_gated_gold,
    "corrupt_suite": q_corrupt_suite,
    "dq_faulty": q_dq_faulty,
    "table_append": q_table_append,
    "sorted_silver": q_sorted_silver,
    "clustered_silver": q_clustered_silver,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_BRONZE = """
geo AS (
  SELECT n_nationkey, n_name,
         CASE r_name WHEN 'AFRICA' THEN 'South' WHEN 'AMERICA' THEN 'West' WHEN 'ASIA' THEN 'East'
                     WHEN 'EUROPE' THEN 'North' WHEN 'MIDDLE EAST' THEN 'East' END AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey),
cz AS (SELECT c_custkey, n_name, zone FROM customer JOIN geo ON c_nationkey = n_nationkey),
ord AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Preparing'
                  WHEN 'O' THEN 'Out for Delivery' END AS st FROM orders),
bronze AS (
  SELECT 'DEL' || CAST(o_orderkey AS VARCHAR) AS delivery_id,
         'CUS' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 4 = 0 THEN '  ' || n_name || ' KITCHEN ' ELSE n_name || ' KITCHEN' END
           AS restaurant_name,
         o_totalprice AS order_amount,
         CAST(5 + o_orderkey % 176 AS INTEGER) AS delivery_minutes,
         CASE WHEN o_orderkey % 3 = 0 THEN zone WHEN o_orderkey % 3 = 1 THEN ' ' || upper(zone) || ' '
              ELSE lower(zone) END AS city_zone,
         CASE WHEN o_orderkey % 5 = 0 THEN ' ' || upper(st) || ' ' WHEN o_orderkey % 2 = 1 THEN upper(st)
              ELSE st END AS delivery_status,
         o_orderstatus, o_orderpriority
  FROM ord JOIN cz ON o_custkey = c_custkey),
silver AS (
  SELECT delivery_id, customer_id, trim(restaurant_name) AS restaurant_name, order_amount,
         delivery_minutes, upper(trim(city_zone)) AS city_zone,
         lower(trim(delivery_status)) AS delivery_status
  FROM bronze),
upd AS (
  SELECT delivery_id, customer_id, trim(restaurant_name) AS restaurant_name, order_amount,
         CAST(delivery_minutes + 7 AS INTEGER) AS delivery_minutes, upper(trim(city_zone)) AS city_zone,
         'completed' AS delivery_status
  FROM bronze WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT delivery_id || '-R', customer_id, trim(restaurant_name), order_amount, delivery_minutes,
         upper(trim(city_zone)), 'preparing'
  FROM bronze WHERE o_orderpriority = '1-URGENT'),
merged AS (
  SELECT * FROM silver s
  WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.delivery_id = s.delivery_id)
  UNION ALL SELECT * FROM upd),
badrows AS (
  SELECT 'BAD' || CAST(c_custkey AS VARCHAR) AS delivery_id, 'CUS' || CAST(c_custkey AS VARCHAR) AS customer_id,
         trim(' ' || c_name || ' ') AS restaurant_name, c_acctbal AS order_amount,
         CAST(20 AS INTEGER) AS delivery_minutes, '' AS city_zone, 'completed' AS delivery_status
  FROM customer WHERE c_acctbal < 0)
"""


def _with(body: str) -> str:
    return "WITH " + _BRONZE.strip() + "\n" + body


def _gold_sql(source: str, completed: bool) -> str:
    extra = ", CAST(count_if(delivery_status = 'completed') AS BIGINT) AS completed_deliveries" if completed else ""
    return f"""
SELECT city_zone, count(delivery_id) AS total_deliveries,
       round(CAST(sum(CAST(order_amount AS DECIMAL(28,8))) AS DOUBLE), 2) AS total_order_value,
       CAST(CAST(sign(sum(delivery_minutes)) AS BIGINT)
            * ((abs(sum(delivery_minutes)) * 200 + count(delivery_minutes))
               // (2 * count(delivery_minutes))) AS DOUBLE) / 100.0 AS average_delivery_minutes{extra}
FROM {source} GROUP BY city_zone ORDER BY city_zone"""


def _rule_rows(source: str, rules) -> str:
    parts = []
    for i, r in rules:
        c = r.column
        if r.kind == "unique":
            parts.append(f"""SELECT {i} AS rule_index, '{r.name}' AS rule, '{c}' AS "column",
  CAST(coalesce(sum(n), 0) AS BIGINT) AS element_count,
  CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT) AS unexpected_count
FROM (SELECT {c} AS k, count(*) AS n FROM {source} GROUP BY {c}) g""")
            continue
        if r.kind == "not_null":
            pred = f"{c} IS NULL"
        elif r.kind == "min":
            pred = f"{c} IS NOT NULL AND NOT ({c} >= {r.value})"
        elif r.kind == "in_set":
            vals = ", ".join(f"'{v}'" for v in r.value)
            pred = f"{c} IS NOT NULL AND {c} NOT IN ({vals})"
        else:
            pred = f"{c} IS NOT NULL AND length({c}) < {r.value}"
        parts.append(f"""SELECT {i} AS rule_index, '{r.name}' AS rule, '{c}' AS "column",
  count(*) AS element_count, CAST(count_if({pred}) AS BIGINT) AS unexpected_count FROM {source}""")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT *, unexpected_count = 0 AS success FROM (\n{body}\n) t"


def _kind_rules(kind):
    rules = [r for r in quality.SILVER_FULL + quality.SILVER_MIN if r.kind == kind]
    return list(enumerate(rules))


_CORRUPT = """,
firsts AS (SELECT delivery_id, row_number() OVER (ORDER BY delivery_id) AS rn
           FROM silver WHERE delivery_id IS NOT NULL ORDER BY delivery_id LIMIT 3),
corrupt AS (
  SELECT CASE WHEN f.rn = 1 THEN NULL ELSE s.delivery_id END AS delivery_id, customer_id, restaurant_name,
         CASE WHEN f.rn = 2 THEN -10.0 ELSE order_amount END AS order_amount, delivery_minutes,
         CASE WHEN f.rn = 3 THEN 'INVALID_ZONE' ELSE city_zone END AS city_zone, delivery_status
  FROM silver s LEFT JOIN firsts f ON s.delivery_id = f.delivery_id)
"""

ORACLE = {
    "stream_upsert": _with("""
SELECT * FROM merged UNION ALL
SELECT CASE WHEN delivery_minutes % 2 = 0 THEN NULL ELSE 'NEW' || customer_id END, customer_id, restaurant_name, order_amount,
       delivery_minutes, city_zone, delivery_status
FROM bronze WHERE o_orderpriority = '5-LOW'"""),
    "silver_standardise": _with("SELECT * FROM silver"),
    "union_by_name": _with("SELECT * FROM silver UNION ALL SELECT * FROM badrows"),
    "merge_upsert": _with("SELECT * FROM merged"),
    "merge_actions": _with("""
SELECT action, count(*) AS n_rows FROM (
  SELECT CASE WHEN EXISTS (SELECT 1 FROM silver s WHERE s.delivery_id = u.delivery_id)
              THEN 'update' ELSE 'insert' END AS action FROM upd u
  UNION ALL
  SELECT 'unchanged' FROM silver s
  WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.delivery_id = s.delivery_id)) a
GROUP BY action"""),
    "merge_conflicts": _with("""
SELECT delivery_id, n_source_rows FROM (
  SELECT 'DEL' || CAST(l_orderkey AS VARCHAR) AS delivery_id, count(*) AS n_source_rows
  FROM lineitem GROUP BY 1 HAVING count(*) > 1) d
WHERE delivery_id IN (SELECT delivery_id FROM silver)"""),
    "schema_append": _with("""
SELECT * FROM silver UNION ALL
SELECT regexp_replace(delivery_id, '-R$', '-L'), customer_id, CAST(NULL AS VARCHAR), order_amount,
       delivery_minutes, city_zone, delivery_status
FROM upd WHERE delivery_id LIKE '%-R'"""),
    "schema_check": _with("""
SELECT 'driver_rating' AS column_name, 'undeclared column' AS issue,
       count((delivery_minutes % 50) / 10.0) AS n_rows FROM silver"""),
    "corrupt_rows": _with(_CORRUPT.rstrip() + "\nSELECT * FROM corrupt"),
    "gold_zone": _with(_gold_sql("silver", False)),
    "gold_completed": _with(_gold_sql("silver", True)),
    "gold_after_merge": _with(_gold_sql("merged", True)),
    "table_count": _with("SELECT count(*) AS row_count FROM merged"),
    "dq_not_null": _with(_rule_rows("silver", _kind_rules("not_null"))),
    "dq_unique": _with(_rule_rows("silver", _kind_rules("unique"))),
    "dq_between": _with(_rule_rows("silver", _kind_rules("min"))),
    "dq_in_set": _with(_rule_rows("silver", _kind_rules("in_set"))),
    "dq_length": _with(_rule_rows("silver", _kind_rules("min_length"))),
    "dq_suite": _with(_rule_rows("silver", list(enumerate(quality.SILVER_FULL)))),
    "dq_failed_list": _with(""", bad AS (SELECT * FROM silver UNION ALL SELECT * FROM badrows),
res AS (""" + _rule_rows("bad", list(enumerate(quality.SILVER_MIN))) + """)
SELECT count(*) AS n_failed,
       CAST(count(*) AS VARCHAR) || ' expectation(s) failed: [' ||
         coalesce(string_agg('''' || rule || '''', ', ' ORDER BY rule_index), '') || ']' AS detail
FROM res WHERE NOT success""".replace("WITH ,", "WITH ")),
    "gated_gold": _with(_gold_sql("silver", False)),
    "corrupt_suite": _with(_CORRUPT.rstrip() + "\n" + _rule_rows("corrupt", list(enumerate(quality.SILVER_FULL)))),
}
ORACLE["table_append"] = ORACLE["schema_append"]
ORACLE["sorted_silver"] = ORACLE["silver_standardise"]
ORACLE["clustered_silver"] = _with("SELECT *, row_number() OVER (ORDER BY delivery_id) AS position FROM silver")
ORACLE["dq_faulty"] = _with(""", faulty AS (
  SELECT * FROM silver UNION ALL SELECT * FROM badrows UNION ALL SELECT * FROM silver WHERE delivery_minutes > 100)
""" + _rule_rows("faulty", list(enumerate(quality.SILVER_FULL + quality.SILVER_MIN))))
