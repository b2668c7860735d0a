"""Physical plans: what reaches the scan, what is shuffled, what never occurs."""

import re

import pytest

import __spark_entry__ as entry
from callflow.plans import queries as catalogue

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalogue.ALL
NEVER = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups", "LocalLimit"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_joins_or_runs_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not [node for node in NEVER if node in plan]
    # whole tables reach one task only as counts: every single-partition exchange
    # stands on an aggregate
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "Aggregate" in lines[i + 1]


@pytest.mark.parametrize("name,pushed", [
    ("retention_expired", "LessThan(ts,"),
    ("calls_yesterday", "GreaterThanOrEqual(ts,"),
    ("source_filters", "GreaterThanOrEqual(ts,"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert re.search(r"PushedFilters: \[[^\]]*" + re.escape(pushed), plan_of(QUERIES[name](spark, FOLDER)))


@pytest.mark.parametrize("name,columns", [
    ("retention_expired", "event_id:bigint,ts:timestamp_ntz"),
    ("retention_kept", "event_id:bigint,ts:timestamp_ntz"),
    ("delete_where", "o_orderkey:bigint,o_orderpriority:string"),
    ("iso_times", "event_id:bigint,ts:timestamp_ntz"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", [
    "duration_seconds", "reject_rows", "update_where", "delete_where", "insert_values",
    "retention_kept", "overlong_text", "feed_union", "malformed_records",
])
def test_row_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, FOLDER))


def test_entry(spark):
    got = entry.entry(spark)
    assert len(got.columns) == 17 and got.count() > 0
    assert got.select("call_id").distinct().count() == got.count()
