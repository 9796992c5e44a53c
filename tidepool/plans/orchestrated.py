"""The gated pipeline: load_silver -> quality_gate -> build_gold -> emit_lineage.

Plain function order replaces the scheduler: an exception in a stage stops
the run, so Gold is only written when the gate passed.  Every stage writes
START/COMPLETE (or FAIL) lineage events; tables and the log live under the
session's shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import gold, lineage, quality
from tidepool.operators.silver import union_by_name
from tidepool.plans import deliveries as dv
from tidepool.session import scratch_path
from tidepool.sources.tables import guarded_scan, write_overwrite

STAGES = ("load_silver", "quality_gate", "build_gold", "emit_lineage")
PIPELINE_JOB = "restaurant_delivery_pipeline"


@dataclass
class RunResult:
    run_id: str
    lineage_run_id: str
    gate_passed: bool
    silver_path: str
    gold_path: str | None
    error: str | None = None


def run_pipeline(spark: SparkSession, sf_dir: str, run_id: str, base: str, log_dir: str,
                 inject_bad_data: bool = False, suite=quality.SILVER_MIN, fmt: str = "parquet") -> RunResult:
    """One orchestrated run; returns what happened instead of raising on a failed gate."""
    rid = lineage.run_uuid(run_id)
    log = lineage.LineageLog(spark, log_dir, rid)
    silver_path, gold_path = f"{base}/silver", f"{base}/gold"
    silver_ds, gold_ds = lineage.dataset(silver_path), lineage.dataset(gold_path)
    log.event(PIPELINE_JOB, "START")
    try:
        with log.stage("load_silver", outputs=[silver_ds]):
            s = dv.silver(spark, sf_dir)
            if inject_bad_data:
                s = union_by_name(s, dv.bad_rows(spark, sf_dir))
            write_overwrite(s, silver_path, fmt)
        with log.stage("quality_gate", inputs=[silver_ds]):
            table = guarded_scan(spark, silver_path, fmt)
            quality.enforce(quality.run_suite(table, suite))
        with log.stage("build_gold", inputs=[silver_ds], outputs=[gold_ds]):
            write_overwrite(gold.zone_metrics(guarded_scan(spark, silver_path, fmt), with_completed=False),
                            gold_path, fmt)
        with log.stage("emit_lineage"):
            # the run-level summary: a single COMPLETE once every stage succeeded
            log.event(PIPELINE_JOB, "COMPLETE")
    except quality.QualityGateFailed as err:
        return RunResult(run_id, rid, False, silver_path, None, str(err))
    return RunResult(run_id, rid, True, silver_path, gold_path)


def clean_and_bad_runs(spark: SparkSession, sf_dir: str) -> tuple[str, list[RunResult]]:
    """A clean scheduled run and one with bad rows injected, into a fresh folder."""
    base = scratch_path(spark, "pipeline")
    log_dir = f"{base}/lineage"
    runs = [
        run_pipeline(spark, sf_dir, "manual__2026-01-01T00:00:00+00:00", f"{base}/run1", log_dir),
        run_pipeline(spark, sf_dir, "manual__2026-01-02T00:00:00+00:00", f"{base}/run2", log_dir,
                     inject_bad_data=True),
    ]
    return log_dir, runs


def q_lineage_trail(spark, sf):
    log_dir, _ = clean_and_bad_runs(spark, sf)
    return lineage.trail(lineage.read_events(spark, log_dir)) \
        .select("run_id", "job_name", "n_events", "last_state")


def q_lineage_states(spark, sf):
    log_dir, _ = clean_and_bad_runs(spark, sf)
    return lineage.stage_states(lineage.read_events(spark, log_dir), STAGES)


def q_lineage_projection(spark, sf):
    """The projected events of both runs, without their clock times."""
    log_dir, _ = clean_and_bad_runs(spark, sf)
    return lineage.project(lineage.read_events(spark, log_dir)).groupBy("eventType", "job_name").agg(F.count(F.lit(1)).alias("n_events"))


def q_lineage_event_types(spark, sf):
    log_dir, _ = clean_and_bad_runs(spark, sf)
    return lineage.event_types(lineage.read_events(spark, log_dir))


def run_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderdate")
    return orders.select(F.concat(F.lit("scheduled__"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                                  F.lit("T00:00:00+00:00")).alias("run_id")).distinct()


def q_lineage_uuid5(spark, sf):
    """L1 as a column: lineage run id of every daily run over the order dates."""
    from tidepool.functions.ids import uuid5
    return run_dates(spark, sf).select("run_id", uuid5(F.col("run_id")).alias("lineage_run_id"))


def broken_log(spark: SparkSession, sf: str) -> str:
    """A log with one event per order, in six shapes by key: alone on a line, over several lines, behind other text, in an
    array with a value that is no event, cut off in a string, and cut off after an object within it."""
    from tidepool.session import scratch_path
    from tidepool.sources.tables import driver_table
    orders = driver_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    state = F.element_at(F.create_map(*[F.lit(x) for x in ("O", "START", "F", "COMPLETE", "P", "FAIL")]), F.col("o_orderstatus"))
    event = F.to_json(F.struct(state.alias("eventType"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("eventTime"),
                               F.struct(F.col("o_orderpriority").alias("name")).alias("job")))
    shape = F.pmod("o_orderkey", F.lit(6))
    text = (F.when(shape == 0, event)
            .when(shape == 1, F.replace(event, F.lit(","), F.lit(",\n ")))
            .when(shape == 2, F.concat(F.lit('worker 3" {ready} '), event, F.lit("}")))
            .when(shape == 3, F.concat(F.lit("["), event, F.lit(", 7]")))
            .when(shape == 4, F.concat(F.lit('{"note": "cut {'), F.col("o_orderpriority")))
            .otherwise(F.concat(F.lit('{"job": {"name": "lost"}, '), event)))
    path = scratch_path(spark, "broken-log")
    orders.select(text.alias("value")).write.text(path)
    return path


def q_lineage_broken_log(spark, sf):
    """What can be read of a log with cut and mixed lines; an object left by a cut event has no type."""
    events = lineage.project(lineage.read_events(spark, broken_log(spark, sf)))
    return events.groupBy("eventType", "job_name", "eventTime").agg(F.count(F.lit(1)).alias("n_events"))


def q_lineage_check(spark, sf):
    """How often each required state was logged."""
    return lineage.state_counts(lineage.read_events(spark, broken_log(spark, sf)))


QUERIES = {
    "lineage_broken_log": q_lineage_broken_log,
    "lineage_check": q_lineage_check,
    "lineage_uuid5": q_lineage_uuid5,
    "lineage_trail": q_lineage_trail,
    "lineage_states": q_lineage_states,
    "lineage_projection": q_lineage_projection,
    "lineage_event_types": q_lineage_event_types,
}

# The runs' events as SQL: run 2 holds the bad rows, so its gate fails exactly where such rows exist.
_EVENTS = """
WITH ids AS (
  SELECT n, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('manual__2026-01-0' || n || 'T00:00:00+00:00')) AS h
  FROM (VALUES (1), (2)) r(n)),
runs AS (
  SELECT n, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
    substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS run_id,
    n = 2 AND EXISTS (SELECT 1 FROM customer WHERE c_acctbal < 0) AS bad FROM ids),
stages AS (SELECT * FROM (VALUES (0, 'load_silver'), (1, 'quality_gate'), (2, 'build_gold'), (3, 'emit_lineage')) s(stage_no, job_name)),
reached AS (
  SELECT run_id, stage_no, job_name, CASE WHEN bad AND stage_no = 1 THEN 'FAIL' ELSE 'COMPLETE' END AS last_state
  FROM runs, stages WHERE NOT bad OR stage_no <= 1),
events AS (
  SELECT run_id, job_name, 'START' AS state FROM reached UNION ALL SELECT run_id, job_name, last_state FROM reached
  UNION ALL SELECT run_id, 'restaurant_delivery_pipeline', 'START' FROM runs
  UNION ALL SELECT run_id, 'restaurant_delivery_pipeline', 'COMPLETE' FROM runs WHERE NOT bad)
"""

# Of an order whose event was cut after an inner object, that object and the whole event in it are left.
_LOGGED = """
WITH logged AS (
  SELECT o_orderkey % 6 AS shape, CASE o_orderstatus WHEN 'O' THEN 'START' WHEN 'F' THEN 'COMPLETE' WHEN 'P' THEN 'FAIL' END AS state,
    strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS job FROM orders),
found AS (
  SELECT state, day, job FROM logged WHERE shape <> 4
  UNION ALL SELECT NULL, NULL, NULL FROM logged WHERE shape = 5)
"""

ORACLE = {
    "lineage_broken_log": _LOGGED + """
SELECT coalesce(state, 'UNKNOWN') AS eventType, coalesce(job, 'UNKNOWN') AS job_name, coalesce(day, 'UNKNOWN') AS eventTime, count(*) AS n_events
FROM found GROUP BY ALL""",
    "lineage_check": _LOGGED + """
SELECT s AS eventType, count(state) AS n_events, count(state) > 0 AS logged
FROM (VALUES ('START'), ('COMPLETE'), ('FAIL')) r(s) LEFT JOIN found ON state = s GROUP BY s""",
    "lineage_trail": _EVENTS + """
SELECT run_id, job_name, count(*) AS n_events, coalesce(max(state) FILTER (state <> 'START'), 'START') AS last_state
FROM events GROUP BY run_id, job_name""",
    "lineage_states": _EVENTS + """
SELECT r.run_id, s.stage_no, s.job_name,
  CASE last_state WHEN 'COMPLETE' THEN 'success' WHEN 'FAIL' THEN 'failed' ELSE 'upstream_failed' END AS state
FROM runs r CROSS JOIN stages s LEFT JOIN reached e ON e.run_id = r.run_id AND e.stage_no = s.stage_no""",
    "lineage_projection": _EVENTS + "SELECT state AS eventType, job_name, count(*) AS n_events FROM events GROUP BY state, job_name",
    "lineage_event_types": _EVENTS + "SELECT DISTINCT state AS eventType FROM events",
    "lineage_uuid5": """
WITH r AS (SELECT DISTINCT 'scheduled__' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' AS run_id
           FROM orders),
h AS (SELECT run_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(run_id)) AS h FROM r)
SELECT run_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
       substr('89ab', ((strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4) + 1, 1) || substr(h, 18, 3)
       || '-' || substr(h, 21, 12) AS lineage_run_id
FROM h""",
}
