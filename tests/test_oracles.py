"""Every registered query against its SQL on the smallest data."""

import pytest
from comparison import connect, difference, rows_of_spark, rows_of_sql

from __spark_entry__ import entry
from monthloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = rows_of_spark(QUERIES[name](spark, FOLDER))
    assert difference(found, rows_of_sql(con, ORACLES[name])) is None


def test_entry(spark):
    assert entry(spark).count() > 0
