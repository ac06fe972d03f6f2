"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from compare import differences, duck
from skyloom.plans.oracle import ORACLE
from skyloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def _checked_plan(df):
    """The query itself, after a look at its plan: no row-at-a-time Python, no cross join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    return df


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, sf, con, name):
    ours = _checked_plan(QUERIES[name](spark, sf)).toPandas()
    assert differences(ours, con.sql(ORACLE[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    assert _checked_plan(QUERIES[name](spark, sf)).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert contract.queries().keys() >= contract.oracle_sql().keys()
