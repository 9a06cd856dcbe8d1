"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from compare import connect, difference, type_difference

import __spark_entry__ as entry
from candlewick.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert type_difference(df, con, ORACLES[name]) == []
    assert difference(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 1


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert {"SMA_7", "SMA_30", "Volatility", "Price_Range"} <= set(df.columns)
    assert df.count() > 0
