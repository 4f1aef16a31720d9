"""Every training-data query with SQL against DuckDB on the smallest tables, and the pipeline's contract."""

import pytest

from tarnlake.llm import queries
from tests.conftest import DATA


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_all_queries_are_registered(spark):
    import __spark_entry__ as e

    assert {*queries.QUERIES, "pipeline"} <= set(e.queries())
    assert DATA.exists()
