"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, connect

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    run, sql = queries()[name], oracle_sql().get(name)
    if sql is None:
        assert run(spark, DATA).count() > 0
    else:
        assert compare(spark, run, sql, connection, DATA) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
