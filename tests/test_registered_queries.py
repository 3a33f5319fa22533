"""Every registered query against its SQL twin, and the shape of every plan."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences, sql_connection
from checks.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SMALL)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 30


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    result = driver.queries()[name](spark, SMALL)
    assert differences(result, connection, driver.oracle_sql()[name]) == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
