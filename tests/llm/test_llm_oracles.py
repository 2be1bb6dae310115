"""Queries with SQL oracles agree with them; all queries give the columns of their contract."""

import pytest
from compare import compare, oracle_connection

from ledgerlens.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, sf_dir, name):
    report = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
    assert report["ok"], report["why"]
    assert report["rows"]
