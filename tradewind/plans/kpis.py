"""Monthly executive, operations and marketing indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import change_pct, month_bucket, ratio, safe_ratio_pct, typed
from tradewind.operators.series import previous

# Order states left out of revenue and customer figures.
EXCLUDED_STATUSES = ("canceled", "unavailable")

SCORE = T.DecimalType(10, 2)


def is_valid(excluded: Sequence[str] = EXCLUDED_STATUSES) -> Column:
    """Orders that count. An unknown (NULL) status does not."""
    return ~F.col("order_status").isin(*excluded)


def valid_orders(
    fact_orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    return fact_orders.where(is_valid(excluded))


def order_month() -> Column:
    return month_bucket(F.col("purchase_timestamp")).alias("order_month")


def ceo_monthly(
    fact_orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Orders, revenue, average order value and growth over the previous row."""
    monthly = (
        valid_orders(fact_orders, excluded)
        .groupBy(order_month())
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_payment").alias("total_revenue"),
        )
    )
    return monthly.select(
        "order_month",
        "total_orders",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
        change_pct(
            F.col("total_revenue"), previous("total_revenue", "order_month")
        ).alias("mom_revenue_growth_pct"),
        change_pct(
            F.col("total_orders"), previous("total_orders", "order_month")
        ).alias("mom_orders_growth_pct"),
    ).orderBy("order_month")


def ops_monthly(fact_deliveries: DataFrame) -> DataFrame:
    """Shipments, deliveries, mean days, on-time and late shares of the delivered."""
    delivered = F.col("delivered_customer_timestamp").isNotNull()
    monthly = fact_deliveries.groupBy(order_month()).agg(
        F.count(F.lit(1)).alias("total_shipments"),
        F.count("delivered_customer_timestamp").alias("total_delivered"),
        F.sum("actual_delivery_days").alias("_days"),
        F.count("actual_delivery_days").alias("_timed"),
        F.count_if(delivered & (F.col("is_late") == 0)).alias("_on_time"),
        F.count_if(F.col("is_late") == 1).alias("_late"),
    )
    share = lambda c: safe_ratio_pct(F.col(c), F.col("total_delivered"))
    return monthly.select(
        "order_month",
        "total_shipments",
        "total_delivered",
        ratio(F.col("_days"), F.col("_timed")).alias("avg_delivery_days"),
        share("_on_time").alias("otd_pct"),
        share("_late").alias("late_delivery_rate_pct"),
    ).orderBy("order_month")


def marketing_monthly(
    fact_orders: DataFrame,
    raw_reviews: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """New customers, orders, share of repeat orders and review score.

    One table of customers and months carries everything: valid orders, and the sum and
    number of scores over orders of every status. Scores are summed per order before
    they join, which then is one to one. A customer has one first valid month, so the
    repeat orders of a month are its orders minus its new customers; that needs no
    ranking of orders, and a customer's rows are as many as their months.
    """
    per_order = raw_reviews.groupBy("order_id").agg(
        F.sum(typed(raw_reviews, "review_score", SCORE)).alias("_score"),
        F.count("review_score").alias("_scored"),
    )
    per_customer = (
        fact_orders.join(per_order, "order_id", "left")
        .groupBy("customer_unique_id", order_month())
        .agg(
            F.count_if(is_valid(excluded)).alias("_orders"),
            F.sum("_score").alias("_score"),
            F.sum("_scored").alias("_scored"),
        )
    )
    # A month without a name is nobody's first.
    active = F.when(F.col("_orders") > 0, F.col("order_month"))
    first = F.min(active).over(Window.partitionBy("customer_unique_id"))
    is_new = F.col("customer_unique_id").isNotNull() & (active == F.col("_first"))
    monthly = (
        per_customer.withColumn("_first", first)
        .groupBy("order_month")
        .agg(
            F.count_if(is_new).alias("new_customers_acquired"),
            F.sum("_orders").alias("total_orders"),
            F.sum("_score").alias("_score"),
            F.sum("_scored").alias("_scored"),
        )
    )
    new = F.col("new_customers_acquired")
    score = F.when(F.col("order_month").isNotNull(), ratio(F.col("_score"), F.col("_scored")))
    return monthly.select(
        "order_month",
        new,
        "total_orders",
        safe_ratio_pct(F.col("total_orders") - new, F.col("total_orders")).alias(
            "repeat_order_share_pct"
        ),
        F.coalesce(score, F.lit(0)).cast("decimal(18,2)").alias("avg_review_score"),
    ).orderBy("order_month")
