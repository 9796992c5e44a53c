"""Lineage: run ids, log shapes, brace scanning, and the events of a clean and a bad run."""

import json
import time
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.functions.ids import uuid5
from tidepool.operators import lineage
from tidepool.operators.json_scan import ObjectScanner
from tidepool.plans import orchestrated

from conftest import SF001


def test_uuid5_expression(spark):
    names = ["nightly-0042", "x", "ünï", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.u for r in df.select(uuid5(F.col("n")).alias("u")).collect()] == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def scanned(text):
    scanner = ObjectScanner()
    return [o for line in text.split("\n") for o in scanner.feed(line)] + scanner.end()


def smallest_end(text, start):
    """Where the object that begins here ends, by trying every closing brace."""
    for end in (i + 1 for i, c in enumerate(text) if c == "}" and i > start):
        try:
            if isinstance(json.loads(text[start:end]), dict):
                return end
        except ValueError:
            pass
    return None


def outermost(text):
    """Every object by every pair of braces, then those not begun within one that was taken."""
    spans = {s: e for s, c in enumerate(text) if c == "{" and (e := smallest_end(text, s))}
    taken, free = [], 0
    for s in sorted(spans):
        if s >= free:
            taken.append(text[s:spans[s]])
            free = spans[s]
    return taken


@pytest.mark.parametrize("text,want", [
    ('{"a": 1}', [{"a": 1}]), ('{"a": {"b": [{}, {"c": 2}]}}{"d": 3}', [{"a": {"b": [{}, {"c": 2}]}}, {"d": 3}]),
    ('[{"a": 1}, {"b": 2}]', [{"a": 1}, {"b": 2}]), ('noise {bad} {"a": "br}ace{"} more', [{"a": "br}ace{"}]),
    ('{"a": 1}{"cut": "of', [{"a": 1}]), ('{junk {"inner": 1} }', [{"inner": 1}]), ("", []), ("}{", []), ('{"q": "\\"{"}', [{"q": '"{'}]),
    ('{"a":\n [1,\n {"b": 2}\n]\n}\n{"c"\n: 3}', [{"a": [1, {"b": 2}]}, {"c": 3}]), ('{"line\nend": 1} {"x": 0}', [{"x": 0}]),
])
def test_object_shapes(text, want):
    assert [json.loads(o) for o in scanned(text)] == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["{", "}", "[", "]", ":", ",", '"', '"', "a", '{"a":', '{"a": 1}', '"{"', "\n", "\\", " ", "1", "null", '":{"', '","', "{}", '{"":"']), max_size=24).map("".join))
def test_objects_by_brute_force(text):
    assert scanned(text) == outermost(text)


def test_long_broken_logs_take_linear_time():
    def seconds(text):
        start = time.process_time()
        found = scanned(text)
        return time.process_time() - start, found

    for shape in ('{"a":', '{"a":[', '{"a": "{', '{"a": "x{\n', '{', '[{"a": 1}, ', '{"a":{"b":{}},\n', '{"{":"{",'):
        few, many = seconds(shape * 4_000), seconds(shape * 32_000)
        assert many[0] < 40 * max(few[0], 0.05), shape
        assert len(many[1]) in (0, 32_000, 8 * len(few[1]))


def test_lines_are_let_go():
    scanner = ObjectScanner()
    for i in range(1000):
        scanner.feed('{"open": "' if i % 2 else f'{{"n": {i}}}')
        assert len(scanner.lines) <= 2


def test_log_shapes(spark, tmp_path):
    lines = [json.dumps({"eventType": s, "eventTime": f"t{i}", "job": {"name": "press"}}) for i, s in enumerate(("START", "COMPLETE"))]
    shapes = {"per_line": "\n".join(lines) + "\n\n", "joined": "".join(lines), "array": f"[{', '.join(lines)}]", "pretty": json.dumps(json.loads(lines[0]), indent=2),
              "noisy": f"-- {lines[0]} }} {{oops {lines[1]}", "nothing": "", "cut": lines[0] + "\n" + lines[1][:20]}
    for name, text in shapes.items():
        (tmp_path / name).write_text(text)
    events = lineage.read_events(spark, str(tmp_path))
    assert {r.eventType: r.n for r in events.groupBy("eventType").agg(F.count(F.lit(1)).alias("n")).collect()} == {"START": 6, "COMPLETE": 4}
    assert lineage.missing_states(events) == ["FAIL"]
    with pytest.raises(AssertionError, match="FAIL"):
        lineage.check_log(events)
    assert {r.job_name for r in lineage.project(events).collect()} == {"press"}


@pytest.mark.parametrize("text,n", [
    ('{"eventType": "STA\n' + '{"a": "b"}\n' * 5, 5), ('it\'s 5" wide {"a": 1} and {"b": "x"}', 2), ('{"cut": "in{"a": 1}', 1), ('{"a": {"b": 1}, "c": "{"}, {"d": 2}', 2),
    ('{"open": [{"a": 1}, {"b": 2}', 2), ('{"a":' * 3000 + "1", 0), ('{"a":' * 5000 + "1" + "}" * 5000, 1),
])
def test_objects_after_faults(text, n):
    assert len(scanned(text)) == n


def test_log_shapes_with_several_objects_or_a_cut(spark, tmp_path):
    lines = [json.dumps({"eventType": s, "eventTime": f"t{i}", "job": {"name": "press"}}) for i, s in enumerate(("START", "COMPLETE"))]
    shapes = {"comma": ", ".join(lines), "comma_lines": ",\n".join(lines), "brackets": f"{lines[0]}],[{lines[1]}", "cut_string": '{"eventType": "STA\n' + "\n".join(lines * 2),
              "null": f"{lines[0]}, null", "commas": f"{lines[0]}\n{lines[0]},{lines[1]}\n{lines[1]}",
              "inner": f'{{"eventType": "START", "inputs": [\n{{"namespace": "n", "name": "x"}}\n]}}'}
    for name, text in shapes.items():
        (tmp_path / name).write_text(text)
    counts = {}
    for name in shapes:
        counts[name] = sorted(str(r.eventType) for r in lineage.read_events(spark, str(tmp_path / name)).collect())
    pair = ["COMPLETE", "START"]
    assert counts == {"comma": pair, "comma_lines": pair, "brackets": pair, "cut_string": sorted(pair * 2), "null": ["START"], "commas": sorted(pair * 2),
                      "inner": ["START"]}


def test_stage_events(spark, tmp_path):
    log = lineage.LineageLog(spark, str(tmp_path / "log"))
    uuid.UUID(log.run_id)
    with log.stage("mix", outputs=[lineage.dataset("dough")]):
        pass
    with pytest.raises(RuntimeError), log.stage("bake"):
        raise RuntimeError("oven is cold")
    states = {(r.job_name, r.last_state, r.n_events, r.detail) for r in lineage.trail(lineage.read_events(spark, str(tmp_path / "log"))).collect()}
    assert states == {("mix", "COMPLETE", 2, None), ("bake", "FAIL", 2, "oven is cold")}


def test_clean_and_bad_runs(spark):
    log_dir, runs = orchestrated.clean_and_bad_runs(spark, SF001)
    assert [r.gate_passed for r in runs] == [True, False] and runs[1].gold_path is None
    events = lineage.read_events(spark, log_dir)
    per_run = {r.run_id: r.n for r in events.groupBy(F.col("run.runId").alias("run_id")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # four stages of two events and two of the pipeline; two stages and the pipeline's start
    assert per_run == {runs[0].lineage_run_id: 10, runs[1].lineage_run_id: 5} and lineage.check_log(events) == 15
    states = {(r.run_id, r.job_name): r.state for r in lineage.stage_states(events, orchestrated.STAGES).collect()}
    assert [states[runs[1].lineage_run_id, s] for s in orchestrated.STAGES] == ["success", "failed", "upstream_failed", "upstream_failed"]
    assert {states[runs[0].lineage_run_id, s] for s in orchestrated.STAGES} == {"success"}
