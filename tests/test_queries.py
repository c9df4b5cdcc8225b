"""Every registered query against its SQL, the others for rows and a stable schema."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), SQL[name], con) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns and len(df.columns) == len(set(df.columns))
    assert df.limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).count() == 4
