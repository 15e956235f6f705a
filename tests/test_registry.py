"""Every registered query against its SQL on the smallest given tables."""

from pathlib import Path

import pytest

from registry import all_queries, all_sql
from tools.agree import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_agrees_with_sql(spark, con, name):
    outcome, _ = compare(spark, con, FOLDER, name)
    assert outcome.startswith("ok"), outcome


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert queries().keys() >= oracle_sql().keys() >= all_queries().keys()
