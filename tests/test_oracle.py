"""Every registered query against its SQL twin; those without one must run and be repeatable in shape."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle

WITH_SQL = sorted(contract.oracle_sql())
WITHOUT_SQL = sorted(set(contract.queries()) - set(WITH_SQL))


@pytest.fixture(scope="module")
def db(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", WITH_SQL)
def test_agrees_with_sql(spark, small, db, name):
    df = contract.queries()[name](spark, small)
    assert oracle.differences(df, contract.oracle_sql()[name], db) == []


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs(spark, small, name):
    df = contract.queries()[name](spark, small)
    assert df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(WITH_SQL) <= set(contract.queries())


def test_entry(spark, small):
    df = contract.entry(spark)
    assert {"award_id", "is_terminated", "representant", "split"} <= set(df.columns)
    assert df.count() > 0
