"""Every query against its SQL oracle on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from tracelake import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()

# No SQL form; checked by brute force or invariants in the other test files.
WITHOUT_ORACLE = {
    "image_digest", "kmeans", "cluster_topics", "cluster_docs",
}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, tables, name):
    assert compare(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["a", "n", "kw"]
