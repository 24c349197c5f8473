"""Every registered query against its SQL, at the smallest scale; and what all plans must not do."""

import pytest

import __spark_entry__ as contract
from carelens.registry import BUILDS, ORACLES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
#: More rows, so that spans with a missing end meet other spans of the same patient.
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def larger():
    return connect(LARGER)


@pytest.mark.parametrize("name", list(BUILDS))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith("ok")


@pytest.mark.parametrize("name", [n for n in BUILDS if n.startswith(("e", "d1", "d2", "d3", "v", "k2", "x9", "x10", "x11")) and n in ORACLES])
def test_spans_on_more_rows(spark, larger, name):
    assert compare(spark, larger, name, LARGER).startswith("ok")


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_no_plan_pairs_rows_or_leaves_the_jvm(spark):
    """No cross join, no nested loop join, no Python code in any plan."""
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas")
    found = {}
    for name in BUILDS:
        plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in banned if b in plan]
        if hits:
            found[name] = hits
    assert not found
