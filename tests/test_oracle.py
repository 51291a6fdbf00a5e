"""Every registered query with SQL, against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equal(spark, duck, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert differences(got, duck.sql(STATEMENTS[name]).df()) == ""


def test_entry(spark):
    assert entry(spark).count() == 5
