"""Every registered query equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from stationcast import catalog

FOLDER = "/root/testdata/sf0.001"
catalog.load()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


def test_catalog_is_served():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    problem, _ = compare(name, QUERIES[name], ORACLES[name], spark, duck, FOLDER)
    assert problem is None, problem


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "count", "bias", "mae", "rmse"] and df.count() > 0
