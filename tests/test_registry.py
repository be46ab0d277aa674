import pytest
from oracle import connect, difference, spark_rows, sql_rows

import __spark_entry__ as entry
from fieldloom import plans

FOLDER = "/root/testdata/sf0.001"
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert [row["count"] for row in rows] == sorted((row["count"] for row in rows), reverse=True)


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracles())
    assert set(plans.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_against_sql(spark, sql, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    found = spark_rows(df)
    assert difference(found, sql_rows(sql, entry.oracle_sql()[name])) is None
