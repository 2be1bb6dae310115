"""Every registered query against its oracle on the smallest data."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_something_is_registered():
    assert len(QUERIES) > 60
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, con, sf_dir):
    report = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
    assert report["ok"], report["why"]
