from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert compare(spark, connection, name, SF) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 5


# Lazy queries whose plans can be looked at without running them.
LAZY = [
    n
    for n in QUERIES
    if not re.search("append|load|csv|export|payloads_to|city_rank|registered", n)
]


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Scan ExistingRDD"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["city_rank", "worst_hours_topk", "worst_months_topk", "period_over_period"])
def test_repeated_runs_agree(spark, name):
    build = QUERIES[name]
    assert build(spark, SF).collect() == build(spark, SF).collect()
