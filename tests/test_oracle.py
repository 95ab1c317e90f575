"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect
from vintora.catalog.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    ok, message = compare(spark, duck, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0
