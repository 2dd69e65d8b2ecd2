"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry_point
from agentlake import example_queries
from tests.compare import bag, duckdb_over, spark_types

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, query in entry_point.queries().items() if name in example_queries.QUERIES}
ORACLES = {name: sql for name, sql in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    assert spark_types(df) == types
    rows = expected.fetchall()
    assert rows, "the comparison would be empty"
    assert bag(df.columns, df.collect()) == bag(columns, rows)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 668
    assert df.columns == QUERIES["turns"](spark, SF_DIR).columns
