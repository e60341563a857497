"""The operators' queries against their SQL on the smallest tables."""

import pytest

from tessera.llm import queries
from tests.test_queries import rows, views  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, views, name):  # noqa: F811
    df = queries.QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = views.execute(queries.ORACLE_SQL[name])
    assert got == rows([c[0] for c in result.description], result.fetchall())
