"""Sums and shares that must agree between reports of the same orders."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tradewind.plans.extracts import analytic_views, extracts
from tradewind.plans.star import star_checks, written_star
from tradewind.sources.retail_tables import RetailTables
from tradewind.sources.tables import replace_table

CENT = Decimal("0.01")


@pytest.fixture(scope="module")
def market(spark, tmp_path_factory):
    """The star of the small tables, written once."""
    tables = RetailTables(spark, SMALL)
    folder = tmp_path_factory.mktemp("star")
    star = written_star(
        {name: replace_table(df, f"{folder}/{name}") for name, df in tables.star.tables().items()}
    )
    views = analytic_views(star, tables)
    return tables, star, views, extracts(star, tables, views, min_route_deliveries=2)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_revenue_and_orders_agree(market):
    _, _, views, frames = market
    revenue = total(frames["ceo_monthly"], "total_revenue")
    orders = total(frames["ceo_monthly"], "total_orders")
    assert revenue == total(frames["time_patterns"], "total_revenue")
    assert revenue == total(frames["rfm_summary"], "total_revenue")
    assert revenue == total(frames["payment_trends"], "payment_value")
    assert orders == total(frames["time_patterns"], "order_count")
    assert orders == total(frames["marketing_monthly"], "total_orders")
    assert orders == total(views["view_rfm_segmentation"], "raw_frequency")


def test_customers_agree(market):
    _, _, _, frames = market
    customers = total(frames["rfm_summary"], "customer_count")
    cohorts = frames["cohort_retention"]
    assert customers == total(cohorts.where("cohort_index = 0"), "cohort_size")
    assert customers == total(frames["marketing_monthly"], "new_customers_acquired")


def test_cohorts_start_whole_and_never_grow(market):
    cohorts = market[3]["cohort_retention"]
    assert cohorts.where("cohort_index = 0 AND retention_pct <> 100").isEmpty()
    assert cohorts.where("active_customers > cohort_size").isEmpty()


def test_on_time_and_late_complete_each_other(market):
    ops = market[3]["ops_monthly"]
    both = F.col("otd_pct") + F.col("late_delivery_rate_pct")
    assert ops.where((F.col("total_delivered") > 0) & (F.abs(both - 100) > CENT)).isEmpty()
    assert ops.where((F.col("total_delivered") == 0) & both.isNotNull()).isEmpty()


def test_fault_shares_complete_each_other(market):
    routes = market[2]["view_delivery_root_cause"]
    both = F.col("seller_fault_share_pct") + F.col("carrier_fault_share_pct")
    assert routes.where((F.col("total_late_deliveries") > 0) & (F.abs(both - 100) > CENT)).isEmpty()
    assert routes.where((F.col("total_late_deliveries") == 0) & both.isNotNull()).isEmpty()


def test_worst_routes_are_sorted_and_busy(market):
    routes = market[3]["delivery_root_cause"].collect()
    rates = [r.late_delivery_rate_pct for r in routes]
    assert routes and rates == sorted(rates, reverse=True)
    assert min(r.total_deliveries for r in routes) >= 2


def test_tiles_are_even(market):
    for column in ("r_score", "m_score"):
        sizes = market[2]["view_rfm_segmentation"].groupBy(column).count().collect()
        counts = [r["count"] for r in sizes]
        assert len(counts) == 4 and max(counts) - min(counts) <= 1


def test_star_constraints_hold(market):
    _, star, _, _ = market
    wide = {"dim_customers": {"state": 20}, "dim_sellers": {"state": 20}}
    for name, violations in star_checks(star, wide, {}).items():
        assert violations.isEmpty(), name


def test_every_tracked_pair_is_delivered_once(market):
    tables, star, _, _ = market
    pairs = (
        tables.items.join(
            tables.orders.where("order_status IN ('delivered', 'shipped')"), "order_id"
        )
        .select("order_id", "seller_id")
        .distinct()
    )
    assert pairs.count() == star.fact_deliveries.count()
