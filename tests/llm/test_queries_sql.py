"""Registered queries beside their SQL, on the small test tables."""

from __future__ import annotations

import pytest

from tests.compare import connect, difference
from tests.conftest import SMALL
from tradewind.llm.oracle import ORACLES
from tradewind.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name]) is None


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
