"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as driver
from conftest import SMOKE_DIR
from tools.compare import compare, connect

QUERIES = driver.library_queries()
# Three hundred rounds each; tools/compare.py runs them, the other tests fit the same models with fewer rounds.
LONG = {"score_gbt", "model_scores", "daily_run"}
ORACLES = {k: v for k, v in driver.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LONG])
def test_query(spark, duck, name):
    same, note = compare(spark, duck, SMOKE_DIR, name, QUERIES[name], ORACLES.get(name))
    assert same, note


def test_every_oracle_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
