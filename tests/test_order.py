"""Results come in the order that they are published in."""

from __future__ import annotations

import pytest

from tests.compare import connect
from tests.conftest import SMALL
from tradewind.registry.duckdb_sql import ORACLES
from tradewind.registry.spark_queries import QUERIES

# Each sort column, and whether it falls.
ORDERS = {
    "P6_ceo_monthly": [("order_month", False)],
    "P7_ops_monthly": [("order_month", False)],
    "P8_marketing_monthly": [("order_month", False)],
    "P10_rfm_summary": [("total_revenue", True), ("rfm_segment", False)],
    "P17_geo_revenue": [("revenue", True)],
    "P18_category_performance": [("revenue", True)],
}


@pytest.mark.parametrize("name", ORDERS)
def test_rows_are_in_order(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    keys = [tuple(r[c] for c, _ in ORDERS[name]) for r in rows]

    def before(a, b):
        for x, y, (_, falls) in zip(a, b, ORDERS[name]):
            if x != y:
                return x > y if falls else x < y
        return True

    assert len(keys) > 1 and all(before(a, b) for a, b in zip(keys, keys[1:]))


def test_sorted_rows_come_as_the_statement_sorts_them(spark):
    mine = [r["o_orderkey"] for r in QUERIES["O1_order_by"](spark, SMALL).collect()]
    theirs = connect(SMALL).execute(ORACLES["O1_order_by"]).fetchall()
    assert mine == [r[0] for r in theirs]
