"""Every registered query against its SQL counterpart, and its plan against the rules for all plans."""

import re

import compare
import pytest
from conftest import plan_of

import __spark_entry__ as entry_points
from millrace.plans import catalog, oracle

QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    check_plan(plan_of(df))
    compare.assert_same(df, con, ORACLE[name])


def check_plan(plan):
    """No cross join, no Python in the plan, no window over a whole table."""
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "MapInArrow"):
        assert operator not in plan
    for first in re.findall(r"windowspecdefinition\(([^,]*),", plan):
        # the first entry is a partition column; an order or a frame means there is none
        assert not first.startswith("specifiedwindowframe") and " ASC" not in first and " DESC" not in first


def test_a_window_over_a_whole_table_would_be_noticed(spark):
    plan = plan_of(spark.range(3).selectExpr("row_number() OVER (ORDER BY id) AS n"))
    with pytest.raises(AssertionError):
        check_plan(plan)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25
