"""Every registered query against its oracle SQL."""

import pytest

import __spark_entry__ as entry
import oracle

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(tables):
    return oracle.connect(tables)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, tables, connection, name):
    assert oracle.difference(QUERIES[name](spark, tables), ORACLES[name], connection) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_query_gives_rows(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 6


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
