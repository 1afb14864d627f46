"""Every query against its DuckDB counterpart on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from bindings import oracles, queries
from tests.parity import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
