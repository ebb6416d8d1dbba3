"""Every query outside the training-data subpackage against its SQL, or for rows."""

import pytest

from turnloom import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, agree):
    agree(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_lists_the_core(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert e.entry(spark).columns[:2] == ["record_id", "turn"]
