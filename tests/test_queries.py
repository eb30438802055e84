"""Every registered query runs, and agrees with its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from tools import check_queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_queries.connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, sf_dir, name):
    verdict, rows = check_queries.compare(spark, con, sf_dir, name)
    assert verdict in ("ok", "rows only")
    assert rows > 0


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_no_cross_join(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    assert entry.entry(spark).columns == ["taxi_type", "reason_code", "trips"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
