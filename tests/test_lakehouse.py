"""Silver clean-up, merge, schema checks, Gold and quality rules on a small bakery's deliveries, worked out by hand."""

import pytest

from tidepool.operators import gold, quality, silver as sv
from tidepool.schemas import DELIVERY_SCHEMA
from tidepool.sources.tables import guarded_scan, write_append, write_overwrite
from tidepool.streaming.upsert import settle

COLUMNS = "delivery_id string, customer_id string, restaurant_name string, order_amount double, delivery_minutes int, city_zone string, delivery_status string"


def trips(spark, *rows):
    """Deliveries from (id, amount, minutes, zone, status)."""
    return spark.createDataFrame([(i, f"shop-{i}", " Rye & Co ", a, m, z, s) for i, a, m, z, s in rows], COLUMNS)


@pytest.fixture()
def base(spark):
    return sv.standardise(trips(spark, ("b1", 10.0, 15, "harbour", " Completed"), ("b2", 20.5, 25, " Harbour ", "COMPLETED "),
                                ("b3", 7.25, 40, "hill", "Cancelled"), ("b4", 2.0, 5, "mill\t", "preparing")))


def by_id(df):
    return {r.delivery_id: r for r in df.collect()}


def test_standardise_trims_spaces_only(base):
    rows = by_id(base)
    assert [rows[i].city_zone for i in ("b1", "b2", "b3", "b4")] == ["HARBOUR", "HARBOUR", "HILL", "MILL\t"]
    assert rows["b2"].delivery_status == "completed" and rows["b1"].restaurant_name == "Rye & Co"


def test_merge_updates_inserts_and_keeps(spark, base):
    batch = trips(spark, ("b3", 8.0, 41, "HILL", "completed"), ("b9", 1.5, 9, "DOCK", "preparing"))
    rows = by_id(sv.merge_upsert(base, batch, ["delivery_id"]))
    assert sorted(rows) == ["b1", "b2", "b3", "b4", "b9"]
    assert (rows["b3"].order_amount, rows["b3"].delivery_minutes) == (8.0, 41) and rows["b1"].order_amount == 10.0
    again = sv.merge_upsert(sv.merge_upsert(base, batch, ["delivery_id"]), batch, ["delivery_id"])
    assert by_id(again) == rows
    actions = {r.action: r.n_rows for r in sv.merge_actions(base, batch, ["delivery_id"]).collect()}
    assert actions == {"update": 1, "insert": 1, "unchanged": 3}
    assert sv.merge_upsert(base, base.limit(0), ["delivery_id"]).count() == 4
    assert {r.action for r in sv.merge_actions(base, base.limit(0), ["delivery_id"]).collect()} == {"unchanged"}


def test_merge_refuses_an_ambiguous_source(spark, base):
    twice = trips(spark, ("b3", 8.0, 41, "HILL", "completed"), ("b3", 9.0, 42, "HILL", "completed"))
    with pytest.raises(Exception, match="AMBIGUOUS_MERGE"):
        sv.merge_upsert(base, twice, ["delivery_id"]).collect()
    with pytest.raises(Exception, match="AMBIGUOUS_MERGE"):
        sv.merge_upsert(base, twice, ["delivery_id"]).count()  # no column is asked for, the check is made all the same
    with pytest.raises(sv.MergeConflict):
        sv.check_merge(base, twice, ["delivery_id"])


def test_merge_inserts_null_keys_and_new_duplicates(spark, base):
    batch = trips(spark, ("n1", 1.0, 6, "DOCK", "preparing"), ("n1", 2.0, 6, "DOCK", "preparing"), (None, 3.0, 6, "DOCK", "x"), (None, 3.0, 6, "DOCK", "x"))
    merged = sv.merge_upsert(base.unionByName(trips(spark, (None, 4.0, 6, "DOCK", "x"))), batch, ["delivery_id"])
    assert sorted(r.order_amount for r in merged.where("delivery_id is null or delivery_id = 'n1'").collect()) == [1.0, 2.0, 3.0, 3.0, 4.0]
    assert merged.count() == 9


def test_settle_reduces_only_matched_duplicates(spark, base):
    batch = trips(spark, ("b1", 1.0, 50, "Z", "x"), ("b1", 2.0, 60, "Z", "x"), ("b1", 3.0, 55, "Z", "x"), ("n", 4.0, 1, "Z", "x"), ("n", 4.0, 1, "Z", "x"),
                  (None, 5.0, 1, "Z", "x"), (None, 5.0, 1, "Z", "x"), ("b2", 6.0, 1, "Z", "x"))
    left = settle(batch, base, ["delivery_id"], "delivery_minutes").collect()
    assert sorted((str(r.delivery_id), r.order_amount) for r in left) == [("None", 5.0), ("None", 5.0), ("b1", 2.0), ("b2", 6.0), ("n", 4.0), ("n", 4.0)]
    with pytest.raises(sv.MergeConflict):
        settle(batch, base, ["delivery_id"])


def test_append_is_checked(spark, base, tmp_path):
    path = str(tmp_path / "silver")
    with pytest.raises(FileNotFoundError):
        guarded_scan(spark, path)
    write_overwrite(base, path)
    with pytest.raises(sv.SchemaMismatch):
        write_append(base.selectExpr("*", "4.5D as rating"), path)
    with pytest.raises(sv.SchemaMismatch):
        write_append(base.withColumn("delivery_minutes", base.customer_id), path)
    assert guarded_scan(spark, path).count() == 4  # a refused append leaves the table as it was
    write_append(base.where("delivery_id = 'b1'").drop("restaurant_name"), path)
    back = guarded_scan(spark, path)
    assert back.count() == 5 and back.where("restaurant_name is null").count() == 1
    assert sv.conform_to_schema(base.drop("city_zone"), DELIVERY_SCHEMA).columns == [f.name for f in DELIVERY_SCHEMA.fields]


def test_sort_by_key(base):
    assert [r.delivery_id for r in sv.sort_by_key(base.repartition(3), "delivery_id").collect()] == ["b1", "b2", "b3", "b4"]


def test_gold(spark, base):
    got = [tuple(r) for r in gold.zone_metrics(base).collect()]
    assert got == [("HARBOUR", 2, 30.5, 20.0, 2), ("HILL", 1, 7.25, 40.0, 0), ("MILL\t", 1, 2.0, 5.0, 0)]


@pytest.mark.parametrize("amounts,total", [([0.005, 0.005, 0.004], 0.01), ([0.1] * 10, 1.0), ([1e17, 1.0], 1e17 + 1), ([2.675], 2.68), ([None, 1.0], 1.0)])
def test_sum_is_rounded_once(spark, amounts, total):
    df = trips(spark, *[(f"d{i}", a, 5, "Z", "x") for i, a in enumerate(amounts)])
    assert gold.zone_metrics(df, with_completed=False).collect()[0][2] == total


def test_sum_keeps_nan(spark):
    total = gold.zone_metrics(trips(spark, ("a", float("nan"), 5, "Z", "x"), ("b", 1.0, 5, "Z", "x")), with_completed=False).collect()[0][2]
    assert total != total


def test_rules_fail_row_by_row(spark, base):
    bad = trips(spark, ("b1", -1.0, 5, "", "lost"), (None, 3.0, 5, "Z", "completed"))
    found = {(r.rule, r.column): (r.element_count, r.unexpected_count) for r in quality.run_suite(base.unionByName(bad), quality.SILVER_FULL + quality.SILVER_MIN).collect()}
    assert found["expect_column_values_to_not_be_null", "delivery_id"] == (6, 1)
    assert found["expect_column_values_to_be_unique", "delivery_id"] == (6, 2)
    assert found["expect_column_values_to_be_between", "order_amount"] == (6, 1)
    assert found["expect_column_value_lengths_to_be_between", "city_zone"] == (6, 1)
    with pytest.raises(quality.QualityGateFailed):
        quality.enforce(quality.run_suite(base.unionByName(bad), quality.SILVER_MIN))


def test_corrupt_rows_fail_the_full_suite(spark):
    good = trips(spark, *[(f"d{i}", 5.0 + i, 10, z, "completed") for i, z in enumerate(("NORTH", "EAST", "SOUTH", "WEST"))])
    assert quality.run_suite(good, quality.SILVER_FULL).where("not success").count() == 0
    failed = quality.run_suite(quality.corrupt_first_rows(good), quality.SILVER_FULL).where("not success").collect()
    assert sorted(r.column for r in failed) == ["city_zone", "delivery_id", "order_amount"] and {r.unexpected_count for r in failed} == {1}


def test_unique_counts_every_duplicate(spark):
    df = spark.createDataFrame([(k,) for k in ("x", "x", "x", "y", None, None)], "delivery_id string")
    row = quality.run_suite(df, [quality.Rule("unique", "delivery_id")]).collect()[0]
    assert (row.element_count, row.unexpected_count, row.success) == (6, 3, False)


def test_empty_table_passes(spark):
    assert quality.run_suite(spark.createDataFrame([], DELIVERY_SCHEMA), quality.SILVER_FULL).where("not success").count() == 0


def test_suite_with_several_unique_columns_reads_the_table_once(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), (None, 2, -1.0), (None, 3, 2.0), ("b", None, 0.5)]
    df = spark.createDataFrame(rows, "id string, n int, x double")
    rules = [quality.Rule("unique", "id"), quality.Rule("not_null", "x"), quality.Rule("unique", "n"), quality.Rule("min", "x", 1), quality.Rule("unique", "id")]
    found = quality.run_suite(df, rules).orderBy("rule_index").collect()
    assert [(r.element_count, r.unexpected_count) for r in found] == [(5, 2), (5, 1), (5, 2), (5, 2), (5, 2)]
    empty = quality.run_suite(df.limit(0), rules).collect()
    assert [(r.element_count, r.unexpected_count, r.success) for r in empty] == [(0, 0, True)] * 5


def test_suite_plan_scans_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int").write.parquet(str(tmp_path / "t"))
    out = quality.run_suite(spark.read.parquet(str(tmp_path / "t")), [quality.Rule("unique", "id"), quality.Rule("unique", "n"), quality.Rule("min", "n", 1)])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
