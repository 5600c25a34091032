import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tidemark.plans import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, db, name):
    assert compare(spark, db, name, registry.QUERIES[name], registry.ORACLES[name], SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 53
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_alerts_plan(spark):
    """The daily limit is applied before the first of two shuffles, and the filter reaches the scan."""
    plan = registry.QUERIES["price_alerts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "GreaterThanOrEqual(value,0.0)" in plan
