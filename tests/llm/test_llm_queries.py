import duckdb
import pytest

from textloom.llm import queries
from tests.test_queries import DATA, db, rows  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, db: duckdb.DuckDBPyConnection, name):  # noqa: F811
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), db.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_sql_belongs_to_queries():
    assert set(queries.ORACLE) <= set(queries.QUERIES)
