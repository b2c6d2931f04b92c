"""Every registered query against its SQL, and the shape of its plan."""

import os
import re

import pytest

import __spark_entry__ as contract
import check
from vacantia.plans.all_queries import ORACLES, QUERIES

FOLDER = os.environ.get("TABLES_DIR", "/root/testdata/sf0.001")
STREAMS = {
    "str1_ingest_scans", "str2_first_seen_stream", "str3_close_absent_stream", "str10_daily_new_stream",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    same, _rows, _seconds, detail = check.compare(spark, con, FOLDER, name)
    assert same is not False, detail


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan_holds_at_scale(spark, no_broadcast, name):
    """No cross join, no row-at-a-time Python, no window over everything."""
    frame = contract.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[-+] (Window|Sort|SortMergeJoin)\b", line):
            below = " ".join(lines[i + 1 : i + 3])
            assert "SinglePartition" not in below, line


def test_filters_and_columns_reach_the_scan(spark):
    frame = contract.queries()["flt7_open_only"](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(o_orderstatus,F))" in plan
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", scan)) == {"o_orderkey", "o_custkey", "o_orderstatus"}


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "id"
