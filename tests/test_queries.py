"""Registered queries against their SQL counterparts on the smallest data set."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs_without_sql(spark, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert len(frame.collect()) > 0 and len(frame.columns) > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 30
