"""Registered queries next to their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from tests.check_oracle import compare, connect
from vintora.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    ok, message = compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF)
    assert ok, message
