"""Every registered query against its SQL, and the contract's three functions."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SMALL
from tradewind.registry.duckdb_sql import ORACLES
from tradewind.registry.spark_queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, duck, SMALL, QUERIES[name], ORACLES[name]) is None


def test_entry_returns_monthly_rows(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "order_month",
        "total_orders",
        "total_revenue",
        "avg_order_value",
        "mom_revenue_growth_pct",
        "mom_orders_growth_pct",
    ]
    assert result.count() > 0
