"""Every registered query against its SQL oracle on the sf0.01 tables."""

import pytest

from conftest import SF01, assert_same, duck

from tidemark.plans import load_all

QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    assert_same(df, con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF01)
    assert df.count() >= 0
