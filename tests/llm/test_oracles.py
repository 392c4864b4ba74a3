"""The llm queries against their SQL on the smallest tables."""

import pytest

from tests.oracle import check, connect
from tidemark.llm import queries


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, con, data, name):
    check(spark, con, data, name, queries.QUERIES[name], queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_without_sql(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0
