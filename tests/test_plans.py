"""Registered queries: agreement with their SQL twins, and the shape of their plans."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_compare import TABLES, compare
from quarterdeck.plans.queries import QUERIES as OWN

SMALL = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # No cross joins anywhere, and no window that would gather a whole table in one task.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Window[^\n]*\n[^\n]*(?:Sort[^\n]*\n[^\n]*)?Exchange SinglePartition", plan)
    if name in ORACLES:
        assert compare(frame, con, ORACLES[name]).startswith("ok")
    else:
        assert frame.count() > 0


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(OWN) <= set(QUERIES)
    assert not [n for n in OWN if "pipeline" in n or re.match(r"op\d", n)]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = QUERIES["raw_table_scan"](spark, SMALL)._jdf.queryExecution().toString()
    lines = [line for line in plan.splitlines() if "FileScan parquet" in line and "l_extendedprice" in line]
    assert lines and all("l_tax" not in line and "l_shipdate" not in line for line in lines)
    losses = QUERIES["competitor_losses"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*o_orderstatus", losses) or "o_orderstatus" in losses


def test_only_hot_key_lists_are_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("deal_sentiment", "query_distances", "booking_allocation", "corpus_chunks", "activity_signals"):
            plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            for part in plan.split("BroadcastExchange")[1:]:
                assert "_parts" in part.split("\n")[1] or "_rows" in part, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
