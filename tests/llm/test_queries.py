"""Registered queries against their SQL on the smallest given tables."""

import pytest

from tools.agree import bag, connect
from trackspark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    result = connect(FOLDER).execute(SQL[name])
    left = bag(df.columns, [tuple(r) for r in df.collect()])
    right = bag([c[0] for c in result.description], result.fetchall())
    assert left[0] == right[0]
    assert not left[1] - right[1], list((left[1] - right[1]).items())[:3]
    assert not right[1] - left[1], list((right[1] - left[1]).items())[:3]


def test_entry_lists_every_query():
    from __spark_entry__ import oracle_sql, queries

    assert QUERIES.keys() <= queries().keys() and SQL.keys() <= oracle_sql().keys()
