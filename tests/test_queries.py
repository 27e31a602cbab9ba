"""Every registered query against its SQL, or for a stable schema and rows where there is none."""

import pytest
from check import connect, difference

from basketry.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, data, duck, name):
    assert difference(QUERIES[name](spark, data), duck, ORACLES[name]) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_has_rows(spark, data, name):
    first = QUERIES[name](spark, data)
    assert first.count() > 0
    assert QUERIES[name](spark, data).schema == first.schema


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_plans_stay_declarative(spark, data):
    """No cross join anywhere, and no Python in the checked queries once orders are known to be small. Properties of learned
    models read scores of Python workers."""
    for name in ORACLES:
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)
        for node in ("EvalPython", "InPandas"):
            assert node not in plan or name.endswith("_properties"), (name, node)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
