"""Every registered query equals its plain SQL."""

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from orderflow.plans import catalog, oracle

QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection.sql(ORACLE[name])) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 10
