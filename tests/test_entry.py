"""Driver contract: entry runs, every query has a callable, oracles name known queries."""

import __spark_entry__ as E
from tidepool.plans import registry

from conftest import SF001


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["city_zone", "total_deliveries", "total_order_value", "average_delivery_minutes"]


def test_registry_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(registry.QUERIES) == set(registry.ORACLE) <= set(q)


def test_some_queries_run_at_smoke_scale(spark):
    q = E.queries()
    for name in ["gold_zone", "dq_suite", "route_summary", "bm25_topk", "rrf", "lineage_uuid5"]:
        assert q[name](spark, SF001).count() > 0
