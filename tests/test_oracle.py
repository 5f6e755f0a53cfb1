"""Every registered query against its SQL on the supplied tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    difference, rows = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert difference is None
    assert rows > 0


def test_every_query_of_the_library_has_sql():
    from dockflow.plans.queries import QUERIES

    # a fit of 337 weights per hour is held against NumPy in test_forecast.py
    assert set(QUERIES) - {"weekly_forecast"} <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "station_id"
    assert df.count() > 0
