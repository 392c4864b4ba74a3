"""Every core query against its SQL on the smallest tables."""

import importlib

import pytest

import __spark_entry__ as entry

from .oracle import check, connect

MODULES = [importlib.import_module(m) for m in entry._CORE]
SQL = {n: s for m in MODULES for n, s in m.ORACLE.items()}
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, data, name):
    check(spark, con, data, name, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
