"""Segments, cohorts, root causes, time patterns and revenue splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import (
    day_name,
    day_of_week,
    fault_flags,
    hour_of_day,
    months_elapsed,
    ratio,
    safe_ratio_pct,
    typed,
    whole_days,
)
from tradewind.operators.joins import scalar_of
from tradewind.operators.ranking import distributed_ntiles
from tradewind.operators.series import share_of_rows, share_of_total, top_rows
from tradewind.plans.kpis import (
    EXCLUDED_STATUSES,
    SCORE,
    order_month,
    valid_orders,
)
from tradewind.plans.star import MONEY_IN, TIMESTAMP

# Segment names.
CHAMPIONS = "Champions"
LOYAL = "Loyal"
RECENT = "New / Recent"
AT_RISK = "At Risk / Can't Lose"
LOST = "Lost"
COLD = "About to Sleep / Cold"


def rfm_raw(
    fact_orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Recency, frequency and monetary value per customer.

    Recency counts from the newest purchase of any status.
    """
    per_customer = (
        valid_orders(fact_orders, excluded)
        .groupBy("customer_unique_id")
        .agg(
            F.max("purchase_timestamp").alias("_last"),
            F.count("order_id").alias("raw_frequency"),
            F.sum("total_payment").alias("raw_monetary"),
        )
    )
    reference = scalar_of(fact_orders, F.max("purchase_timestamp"))
    return per_customer.select(
        "customer_unique_id",
        whole_days(F.col("_last"), reference).alias("raw_recency_days"),
        "raw_frequency",
        "raw_monetary",
    )


def rfm_segmentation(
    fact_orders: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
    tiles: int = 4,
) -> DataFrame:
    """Raw values, scores and segment per customer.

    Recency and money are split into tiles (ties by customer); frequency goes
    by fixed steps because nearly every customer orders once.
    """
    customer = F.asc("customer_unique_id")
    scored = distributed_ntiles(
        rfm_raw(fact_orders, excluded),
        {
            "r_score": (tiles, [F.desc_nulls_first("raw_recency_days"), customer]),
            "m_score": (tiles, [F.asc_nulls_last("raw_monetary"), customer]),
        },
    )
    steps = F.when(F.col("raw_frequency") == 1, 1).when(F.col("raw_frequency") == 2, 3)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # The segments' rules, in their order.
    segment = (
        F.when((r == 4) & (f >= 3) & (m >= 3), CHAMPIONS)
        .when((r >= 3) & (f >= 3), LOYAL)
        .when((r >= 3) & (f == 1), RECENT)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r == 1) & (f == 1) & (m == 1), LOST)
        .otherwise(COLD)
    )
    return scored.withColumn("f_score", steps.otherwise(4)).select(
        "customer_unique_id",
        "raw_recency_days",
        "raw_frequency",
        "raw_monetary",
        "r_score",
        "f_score",
        "m_score",
        segment.alias("rfm_segment"),
    )


def rfm_summary(segments: DataFrame) -> DataFrame:
    """Customers, revenue, their shares and mean lifetime spend per segment."""
    grouped = segments.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("raw_monetary").alias("total_revenue"),
        F.count("raw_monetary").alias("_spenders"),
    )
    shared = share_of_rows(grouped, "customer_count", "customer_share_pct")
    shared = share_of_rows(shared, "total_revenue", "revenue_share_pct")
    return shared.select(
        "rfm_segment",
        "customer_count",
        "customer_share_pct",
        F.round("total_revenue", 2).alias("total_revenue"),
        "revenue_share_pct",
        ratio(F.col("total_revenue"), F.col("_spenders")).alias("aov"),
    ).orderBy(F.desc("total_revenue"), "rfm_segment")


def cohort_retention(
    fact_orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Customers of each first-purchase month who order again, by month since.

    Orders collapse to distinct (customer, month) pairs first. A customer then
    has one row per calendar month at most, which bounds the window group, and
    each pair counts once, so plain counts equal distinct customers. Month 0
    holds the whole cohort, so its count is the cohort size.
    """
    active = (
        valid_orders(fact_orders, excluded)
        .select("customer_unique_id", order_month())
        .distinct()
    )
    per_customer = Window.partitionBy("customer_unique_id")
    placed = active.withColumn("cohort_month", F.min("order_month").over(per_customer))
    counts = placed.groupBy(
        "cohort_month",
        months_elapsed(F.col("cohort_month"), F.col("order_month")).alias("cohort_index"),
    ).agg(F.count(F.lit(1)).alias("active_customers"))
    at_start = F.when(F.col("cohort_index") == 0, F.col("active_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort_month"))
    return (
        counts.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "cohort_size",
            "cohort_index",
            "active_customers",
            safe_ratio_pct(F.col("active_customers"), F.col("cohort_size")).alias(
                "retention_pct"
            ),
        )
        .orderBy("cohort_month", "cohort_index")
    )


def with_faults(milestones: DataFrame) -> DataFrame:
    """Both fault flags for deliveries that carry their handover and shipping limit."""
    seller_fault, carrier_fault = fault_flags(
        F.col("is_late"),
        F.col("carrier_handover_timestamp"),
        F.col("shipping_limit_timestamp"),
    )
    return milestones.withColumns({"is_seller_late": seller_fault, "is_carrier_late": carrier_fault})


def delivery_milestones(
    fact_deliveries: DataFrame, raw_orders: DataFrame, raw_items: DataFrame
) -> DataFrame:
    """Stored deliveries with carrier handover, shipping limit and both fault flags.

    For deliveries that are still to be built, ``star.tracked_deliveries`` has the
    same columns from a single pass over the items.
    """
    # The greatest value as delivered, cast afterwards: for ISO text the latest.
    limits = raw_items.groupBy("order_id", "seller_id").agg(
        F.max("shipping_limit_date").alias("shipping_limit_date")
    )
    limits = limits.select(
        "order_id",
        "seller_id",
        typed(limits, "shipping_limit_date", TIMESTAMP).alias("shipping_limit_timestamp"),
    )
    handovers = raw_orders.select(
        "order_id",
        typed(raw_orders, "order_delivered_carrier_date", TIMESTAMP).alias(
            "carrier_handover_timestamp"
        ),
    )
    return with_faults(
        fact_deliveries.join(handovers, "order_id").join(limits, ["order_id", "seller_id"])
    )


def delivery_root_cause(
    milestones: DataFrame, dim_sellers: DataFrame, dim_customers: DataFrame
) -> DataFrame:
    """Late deliveries per route, split into seller and carrier faults.

    ``milestones`` are deliveries with fault flags. Spark broadcasts the sellers or
    splits a busy one. Deliveries then are summed per (customer, seller state), so a
    busy customer reaches its dimension with one row per seller state.
    """
    sellers = dim_sellers.select("seller_id", F.col("state").alias("seller_state"))
    customers = dim_customers.select(
        "customer_unique_id", F.col("state").alias("customer_state")
    )
    with_seller = milestones.select(
        "seller_id", "customer_unique_id", "is_late", "is_seller_late", "is_carrier_late"
    ).join(sellers, "seller_id")
    by_origin = with_seller.groupBy("customer_unique_id", "seller_state").agg(
        F.count(F.lit(1)).alias("_deliveries"),
        F.sum("is_late").alias("_late"),
        F.sum("is_seller_late").alias("_seller"),
        F.sum("is_carrier_late").alias("_carrier"),
    )
    routes = (
        by_origin.join(customers, "customer_unique_id")
        .groupBy("seller_state", "customer_state")
        .agg(*[F.sum(c).alias(c) for c in ("_deliveries", "_late", "_seller", "_carrier")])
    )
    return routes.select(
        "seller_state",
        "customer_state",
        F.col("_deliveries").alias("total_deliveries"),
        F.col("_late").alias("total_late_deliveries"),
        safe_ratio_pct(F.col("_late"), F.col("_deliveries")).alias("late_delivery_rate_pct"),
        safe_ratio_pct(F.col("_seller"), F.col("_late")).alias("seller_fault_share_pct"),
        safe_ratio_pct(F.col("_carrier"), F.col("_late")).alias("carrier_fault_share_pct"),
    )


def worst_routes(
    root_cause: DataFrame, min_deliveries: int = 100, limit: int | None = None
) -> DataFrame:
    """Routes with enough deliveries, highest late rate first."""
    busy = root_cause.where(F.col("total_deliveries") >= min_deliveries)
    ties = ["seller_state", "customer_state"]
    if limit is not None:
        return top_rows(busy, limit, "late_delivery_rate_pct", ties)
    return busy.orderBy(F.desc_nulls_first("late_delivery_rate_pct"), *ties)


def time_patterns(
    fact_orders: DataFrame, excluded: Sequence[str] = EXCLUDED_STATUSES
) -> DataFrame:
    """Orders, revenue and share of orders per weekday and hour."""
    ts = F.col("purchase_timestamp")
    grouped = (
        valid_orders(fact_orders, excluded)
        .groupBy(day_of_week(ts).alias("day_of_week"), hour_of_day(ts).alias("hour_of_day"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.round(F.sum("total_payment"), 2).alias("total_revenue"),
        )
    )
    return (
        share_of_total(grouped, "order_count", "order_share_pct")
        .select(
            "day_of_week",
            day_name(F.col("day_of_week")).alias("day_name"),
            "hour_of_day",
            "order_count",
            "total_revenue",
            "order_share_pct",
        )
        .orderBy("day_of_week", "hour_of_day")
    )


def peak_hours(patterns: DataFrame, limit: int = 5) -> DataFrame:
    """The busiest hours over all weekdays, with their share of all orders."""
    hourly = patterns.groupBy("hour_of_day").agg(F.sum("order_count").alias("total_orders"))
    shared = share_of_total(hourly, "total_orders", "share_pct")
    return top_rows(shared, limit, "total_orders", ["hour_of_day"])


def weekday_distribution(patterns: DataFrame) -> DataFrame:
    """Orders and share per weekday, Sunday first."""
    daily = patterns.groupBy("day_of_week", "day_name").agg(
        F.sum("order_count").alias("total_orders")
    )
    return (
        share_of_total(daily, "total_orders", "share_pct")
        .orderBy("day_of_week")
        .select("day_name", "total_orders", "share_pct")
    )


def geo_revenue(
    fact_orders: DataFrame,
    dim_customers: DataFrame,
    limit: int = 10,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """Top states by revenue, with their share of all revenue.

    Revenue is summed per customer before the join, so it is one to one.
    """
    valid = valid_orders(fact_orders, excluded)
    spend = valid.groupBy("customer_unique_id").agg(F.sum("total_payment").alias("_spend"))
    states = (
        spend.join(dim_customers.select("customer_unique_id", "state"), "customer_unique_id")
        .groupBy("state")
        .agg(F.sum("_spend").alias("revenue"))
    )
    everything = scalar_of(valid, F.sum("total_payment"))
    ranked = top_rows(states, limit, "revenue", ["state"])
    return ranked.select(
        "state",
        F.round("revenue", 2).alias("revenue"),
        safe_ratio_pct(F.col("revenue"), everything).alias("revenue_share_pct"),
    )


def category_performance(
    fact_orders: DataFrame,
    raw_items: DataFrame,
    raw_reviews: DataFrame,
    dim_products: DataFrame,
    limit: int = 15,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """Top categories by item revenue, with item-weighted score and order count.

    Items collapse to one row per (order, category) before they meet orders
    and reviews. Each such row is one distinct order of the category, and its
    item count weights the order's mean score.
    """
    items = raw_items.select(
        "order_id", "product_id", typed(raw_items, "price", MONEY_IN).alias("_price")
    )
    categories = dim_products.select("product_id", "category_english")
    baskets = (
        items.join(categories, "product_id")
        .groupBy("order_id", "category_english")
        .agg(F.sum("_price").alias("_price"), F.count(F.lit(1)).alias("_items"))
    )
    wide = T.DecimalType(20, 2)
    scores = raw_reviews.groupBy("order_id").agg(
        (
            F.sum(typed(raw_reviews, "review_score", SCORE)).cast(wide)
            / F.count("review_score").cast(T.DecimalType(18, 0))
        )
        .cast(T.DecimalType(22, 16))
        .alias("_score")
    )
    weight = F.col("_items").cast(T.DecimalType(14, 0))
    per_category = (
        baskets.join(valid_orders(fact_orders, excluded).select("order_id"), "order_id")
        .join(scores, "order_id", "left")
        .groupBy("category_english")
        .agg(
            F.sum("_price").alias("_revenue"),
            F.sum(F.col("_score") * weight).alias("_points"),
            F.sum(F.when(F.col("_score").isNotNull(), weight)).alias("_rated"),
            F.count(F.lit(1)).alias("total_orders"),
        )
    )
    mean_score = F.col("_points") / F.nullif("_rated", F.lit(0)).cast(T.DecimalType(20, 0))
    summary = per_category.select(
        "category_english",
        F.round("_revenue", 2).alias("revenue"),
        F.round(mean_score, 2).cast(T.DecimalType(18, 2)).alias("avg_review_score"),
        "total_orders",
    )
    return top_rows(summary, limit, "revenue", ["category_english"])


def payment_trends(
    fact_orders: DataFrame,
    raw_payments: DataFrame,
    excluded: Sequence[str] = EXCLUDED_STATUSES,
) -> DataFrame:
    """Payments and value per month and payment type.

    Payments are summed per (order, type) before the join to their order.
    """
    per_order = raw_payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(typed(raw_payments, "payment_value", MONEY_IN)).alias("_value"),
    )
    months = valid_orders(fact_orders, excluded).select("order_id", order_month())
    return (
        per_order.join(months, "order_id")
        .groupBy("order_month", "payment_type")
        .agg(
            F.sum("_n").alias("transaction_count"),
            F.round(F.sum("_value"), 2).alias("payment_value"),
        )
        .orderBy("order_month", F.desc("payment_value"), "payment_type")
    )
