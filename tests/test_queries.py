"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf_dir, con, name):
    assert compare(spark, con, name, entry.queries()[name], SQL.get(name), sf_dir) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
