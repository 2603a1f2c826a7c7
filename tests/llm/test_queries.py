"""Every query of the operators on the smallest tables: against DuckDB where it has SQL."""

import pytest

from tessera.llm import queries
from tests.oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, name):
    assert assert_same(queries.QUERIES[name](spark, sf), queries.SQL[name], connect(sf)) > 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == [*range(1, 14)]
