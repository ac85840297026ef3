"""Figures derived from the monthly series, routes and cohorts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import (
    change_pct,
    primary_driver,
    ratio,
    route_label,
)
from tradewind.operators.series import (
    active_period,
    period_range,
    point_change,
    previous,
    rolling_sums,
    top_rows,
)

MONTH = "order_month"

# Default reporting window and month, delivery target and the
# payment types shown.
FIRST_MONTH = "2017-01-01"
LAST_MONTH = "2018-08-01"
TARGET_DAYS = 10
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")


def ltm_growth(ceo: DataFrame, months: int = 12) -> DataFrame:
    """Rolling year of revenue and orders, and growth over the prior one."""
    rolled = rolling_sums(
        ceo.select(MONTH, "total_revenue", "total_orders"),
        MONTH,
        ["total_revenue", "total_orders"],
        months,
    ).select(
        MONTH,
        F.col("ltm_total_revenue").alias("ltm_revenue"),
        F.col("ltm_total_orders").alias("ltm_orders"),
        F.col("prior_ltm_total_revenue").alias("prior_ltm_revenue"),
        F.col("prior_ltm_total_orders").alias("prior_ltm_orders"),
    )
    return rolled.select(
        "*",
        change_pct(F.col("ltm_revenue"), F.col("prior_ltm_revenue")).alias(
            "ltm_revenue_growth_pct"
        ),
        change_pct(F.col("ltm_orders"), F.col("prior_ltm_orders")).alias(
            "ltm_orders_growth_pct"
        ),
    )


def aov_growth(ceo: DataFrame, rounded: bool = True) -> DataFrame:
    """Growth of the average order value over the previous row.

    ``rounded`` compares the published two-decimal values; otherwise the value
    is recomputed from revenue and orders (at least one) as doubles.
    """
    if rounded:
        valued = ceo.select(MONTH, F.col("avg_order_value").alias("aov"))
    else:
        orders = F.greatest(F.lit(1), "total_orders")
        exact = F.col("total_revenue").cast("double") / orders.cast("double")
        valued = ceo.select(MONTH, exact.alias("aov"))
    before = previous("aov", MONTH)
    if rounded:
        return valued.withColumn("aov_growth_pct", change_pct(F.col("aov"), before))
    growth = F.when(before > 0, (F.col("aov") - before) / before * 100).when(
        before.isNotNull(), 0.0
    )
    return valued.select(
        MONTH, F.round("aov", 2).alias("aov"), F.round(growth, 2).alias("aov_growth_pct")
    )


def ops_changes(ops: DataFrame) -> DataFrame:
    """Month-over-month changes of on-time rate, delivery days and late rate."""
    return point_change(ops, MONTH, ["otd_pct", "avg_delivery_days", "late_delivery_rate_pct"])


def marketing_changes(marketing: DataFrame) -> DataFrame:
    """Month-over-month changes of repeat share and review score."""
    return point_change(marketing, MONTH, ["repeat_order_share_pct", "avg_review_score"])


def acquisition_growth(marketing: DataFrame, at_least_one: bool = False) -> DataFrame:
    """Growth of new customers over the previous row.

    After a month without new customers the growth is unknown;
    ``at_least_one`` divides by one there instead.
    """
    now, before = F.col("new_customers_acquired"), previous("new_customers_acquired", MONTH)
    base = F.when(before.isNotNull(), F.greatest(F.lit(1), before)) if at_least_one else before
    growth = ratio((now - before) * 100, base)
    return marketing.select(
        MONTH, "new_customers_acquired", growth.alias("acquisition_growth_pct")
    )


def active_month(series: DataFrame, target: date | str = LAST_MONTH) -> DataFrame:
    """The reporting month's row, else the last but one."""
    return active_period(series, MONTH, target)


def month_range(
    series: DataFrame, first: date | str = FIRST_MONTH, last: date | str = LAST_MONTH
) -> DataFrame:
    return period_range(series, MONTH, first, last)


def top_routes(routes: DataFrame, limit: int = 8) -> DataFrame:
    """Worst routes with their label and main cause."""
    worst = top_rows(
        routes, limit, "late_delivery_rate_pct", ["seller_state", "customer_state"]
    )
    return worst.select(
        route_label(F.col("seller_state"), F.col("customer_state")).alias("route"),
        *worst.columns,
        primary_driver(F.col("carrier_fault_share_pct")).alias("primary_driver"),
    )


def cohort_curve(
    retention: DataFrame, cohort: date | str = FIRST_MONTH, min_months: int = 12
) -> DataFrame:
    """One cohort's retention from month 1 on, with 0 where nobody returned."""
    chosen = retention.where(F.col("cohort_month") == F.lit(cohort).cast("date"))
    last = F.greatest(F.max("cohort_index"), F.lit(min_months))
    timeline = chosen.agg(last.alias("_last")).select(
        F.explode(F.sequence(F.lit(1), "_last")).alias("cohort_index")
    )
    return (
        timeline.join(chosen.select("cohort_index", "retention_pct"), "cohort_index", "left")
        .select(
            "cohort_index",
            F.coalesce("retention_pct", F.lit(0)).cast("decimal(18,2)").alias("retention_pct"),
        )
        .orderBy("cohort_index")
    )


def payment_pivot(trends: DataFrame, types: Sequence[str] = PAYMENT_TYPES) -> DataFrame:
    """Payment value per month with one column per listed type, 0 if none."""
    wide = trends.groupBy(MONTH).pivot("payment_type", list(types)).agg(F.sum("payment_value"))
    return wide.select(
        MONTH, *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).alias(t) for t in types]
    ).orderBy(MONTH)


def sla_trend(ops: DataFrame, target_days: int = TARGET_DAYS) -> DataFrame:
    """Mean delivery days against the constant target."""
    return ops.select(
        MONTH,
        "avg_delivery_days",
        F.lit(target_days).alias("sla_days"),
        (F.col("avg_delivery_days") > target_days).alias("breached"),
    ).orderBy(MONTH)
