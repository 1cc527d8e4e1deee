"""Every registered text query that has SQL, on whole tables."""

import pytest

from tests.llm.conftest import FOLDER, SMALL
from tidemark.llm.queries import QUERIES, oracles

SQL = oracles()


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("folder", [SMALL, FOLDER])
def test_query_equals_sql(spark, sql_rows, spark_rows, name, folder):
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(SQL[name], folder)
