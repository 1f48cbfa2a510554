"""Every registered query against its SQL twin, value by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from martwright.plans.queries import QUERIES
from martwright.plans.twins import TWIN_SQL
from conftest import plan_text
from checks import DATA, first_difference, twin_connection, twin_rows, spark_rows

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return twin_connection(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWIN_SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(TWIN_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_its_twin(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    plan = plan_text(df)
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    mine = spark_rows(df)
    theirs = twin_rows(duck, driver.oracle_sql()[name])
    assert first_difference(mine, theirs) is None
    assert mine[1], "a query that returns nothing checks nothing"


def test_entry(spark):
    assert driver.entry(spark).count() == 10
