"""Every registered query of the caption engine: against DuckDB where it has SQL, else that it runs."""

import pytest

from tessera.plans import annotated, language, queries, round_trips, stage5, updates  # noqa: F401 - they register their queries
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, con, name):
    assert_same(queries.QUERIES[name](spark, sf), queries.SQL[name], con)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
