"""Every registered query against its SQL in DuckDB."""

import pytest

from __spark_entry__ import entry
from conftest import SMALL
from oracle_check import compare, connect
from tidewater.plans.oracle import oracle_sql
from tidewater.plans.queries import queries


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SMALL) is None


def test_entry(spark):
    top = entry(spark)
    assert top.columns == ["tm_id", "tm_name", "amount"]
    assert top.count() == 5


@pytest.mark.parametrize("name", list(queries()))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


@pytest.mark.parametrize(
    "name, column",
    [
        ("dau_total_day", "ts"), ("order_total_day", "o_orderdate"), ("order_hour_day", "o_orderdate"),
        ("hour_compare_day", "o_orderdate"), ("trademark_topn_range", "o_orderdate"),
    ],
)
def test_reports_of_some_days_filter_in_the_scan(spark, name, column):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any(f"GreaterThanOrEqual({column}," in line and f"LessThan({column}," in line for line in pushed)
