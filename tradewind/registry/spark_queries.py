"""One query per operator, run over whole tables.

Results are in extract form: decimals as doubles, dates as ISO text.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import functions as fn
from tradewind.operators import aggregates, dedupe, joins, quality, ranking, series
from tradewind.plans import analytics, dashboards, kpis
from tradewind.plans import star as star_plan
from tradewind.session import scratch_path
from tradewind.sources import csv_tables, tables
from tradewind.sources.retail_tables import AMOUNT, OTHER_EVENTS, Query, RetailTables

QUERIES: dict[str, Query] = {}

# Reporting window and cohort that exist in the test tables.
FIRST_MONTH, LAST_MONTH = "1996-01-01", "1998-08-01"
COHORT = "1995-01-01"
MIN_ROUTE_DELIVERIES = 50
SLA_DAYS = 1300
FLAGS = ("A", "N", "R")


def query(name: str):
    """Register a builder taking the tables; its result is put in extract form."""

    def register(build: Callable[[RetailTables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tables.to_extract_types(build(RetailTables(spark, folder)))

        QUERIES[name] = run
        return build

    return register


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Integers that may be NULL as doubles, which every consumer reads alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def orders_with(t: RetailTables, **columns) -> DataFrame:
    picked = [c.alias(name) for name, c in columns.items()]
    return t.table("orders").select("o_orderkey", *picked)


# --- Sources and sinks ---------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@query("S1_read_raw_csv")
def _(t):
    path = scratch_path(t.spark, "csv")
    _write_csv(t.table("documents"), path)
    return csv_tables.read_raw_csv(t.spark, path)


@query("S2_normalize_columns")
def _(t):
    return csv_tables.normalize_columns(
        t.table("orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus")
        .toDF("\ufefforder_id", " Customer ID ", "ORDER STATUS")
    )


@query("S1_read_two_files")
def _(t):
    """One table delivered as several files, read by one header."""
    path = scratch_path(t.spark, "csv")
    _write_csv(t.table("orders").select("o_orderkey", "o_orderpriority").repartition(2), path)
    return csv_tables.read_raw_csv(t.spark, path, multi_line=False)


@query("S3_load_all")
def _(t):
    folder, warehouse = scratch_path(t.spark, "feed"), scratch_path(t.spark, "warehouse")
    feeds = {
        "shop_orders_dataset.csv": t.orders,
        "shop_order_items_dataset.csv": t.items,
        "shop_customers_dataset.csv": t.customers,
        "shop_sellers_dataset.csv": t.sellers,
        "shop_products_dataset.csv": t.products,
        "shop_order_payments_dataset.csv": t.payments,
        "shop_order_reviews_dataset.csv": t.reviews,
        "shop_geolocation_dataset.csv": t.table("nation"),
        "product_category_name_translation.csv": t.translation,
    }
    for name, df in feeds.items():
        _write_csv(df, f"{folder}/{name}")
    return csv_tables.load_all(
        t.spark, folder, warehouse, "shop_", splittable=["raw_order_items"]
    ).counts


@query("S4_replace_table")
def _(t):
    path = scratch_path(t.spark, "table")
    tables.replace_table(t.table("customer"), path)
    orders = t.table("orders").withColumn("order_month", fn.month_bucket(F.col("o_orderdate")))
    return tables.replace_table(orders, path, partition_by=["order_month"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_month"
    )


@query("S5_register_views")
def _(t):
    tables.register_views(
        {
            "ceo_monthly_kpis": kpis.ceo_monthly(t.star.fact_orders),
            "ops_monthly_kpis": kpis.ops_monthly(t.star.fact_deliveries),
        }
    )
    return t.spark.sql(
        "SELECT c.order_month, c.total_orders, o.total_shipments "
        "FROM ceo_monthly_kpis c JOIN ops_monthly_kpis o ON c.order_month = o.order_month"
    )


@query("S6_export_json")
def _(t):
    path = scratch_path(t.spark, "extract")
    extract = kpis.ceo_monthly(t.star.fact_orders)
    tables.export_json(extract, path, single_file=True)
    return t.spark.read.schema(tables.to_extract_types(extract).schema).json(path)


# --- Profiling and data quality ------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("Q1_row_count_metric")
def _(t):
    return quality.row_count_metric(t.table("lineitem"), LINE_KEY, "duplicate_line_keys")


@query("Q2_duplicate_keys")
def _(t):
    return quality.duplicate_keys(t.table("lineitem"), LINE_KEY)


@query("Q3_missing_profile")
def _(t):
    return quality.missing_profile(
        t.orders,
        {
            "order_id": "missing_order_id",
            "customer_id": "missing_customer_id",
            "order_status": "missing_order_status",
            "order_purchase_timestamp": "missing_purchase_timestamp",
            "order_delivered_customer_date": "missing_delivered_date",
        },
    )


@query("Q4_category_distribution")
def _(t):
    return quality.category_distribution(t.payments, "payment_type", F.col("payment_value"))


@query("Q5_value_anomalies")
def _(t):
    return quality.value_anomalies(
        t.table("customer").select(F.col("c_acctbal").cast(AMOUNT).alias("v")), F.col("v")
    )


@query("Q6_missing_category_profile")
def _(t):
    return quality.missing_profile(
        t.products, {"product_category_name": "missing_category_name"}, "total_products"
    )


@query("Q7_unmatched_values")
def _(t):
    return quality.unmatched_values(
        t.products,
        "product_category_name",
        t.translation,
        "product_category_name",
        "untranslated_category",
    )


@query("Q8_check_unique")
def _(t):
    return quality.check_unique(t.table("lineitem"), LINE_KEY)


@query("Q9_check_not_null")
def _(t):
    return quality.check_not_null(
        t.star.fact_orders,
        [
            "order_id",
            "purchase_timestamp",
            "approved_timestamp",
            "delivered_carrier_timestamp",
            "delivered_customer_timestamp",
        ],
    )


@query("Q10_check_foreign_key")
def _(t):
    return quality.check_foreign_key(t.table("documents"), "doc_id", t.table("labels"), "doc_id")


@query("Q11_check_domain")
def _(t):
    return quality.check_domain(
        t.star.dim_customers,
        max_length={"state": 2, "city": 100, "zip_code_prefix": 10},
        max_abs={"customer_unique_id": 100},
    )


@query("Q12_validate_row_counts")
def _(t):
    return quality.validate_row_counts(t.star.tables())


# --- Cleaning and scalar functions ----------------------------------------


@query("C1_insert_if_absent")
def _(t):
    rows = (*star_plan.MISSING_TRANSLATIONS, ("PROMO", "replaced"))
    return star_plan.clean_translations(t.translation, rows)


@query("C2_blank_to_null")
def _(t):
    urgent = F.regexp_replace("o_orderpriority", "^5-LOW$", "")
    return orders_with(t, priority=fn.blank_to_null(urgent))


@query("C3_safe_cast")
def _(t):
    text = t.products.select(
        "product_id",
        "product_length_cm",
        "product_width_cm",
        F.concat("product_width_cm", F.lit(".255")).alias("price_text"),
        F.when(F.col("product_length_cm") != "", "2017-10-02 10:56:33").otherwise("").alias("ts"),
    )
    return text.select(
        "product_id",
        fn.safe_cast(F.col("product_length_cm"), T.IntegerType())
        .cast("double")
        .alias("length_cm"),
        fn.safe_cast(F.col("price_text"), T.DecimalType(18, 4)).alias("price"),
        fn.safe_cast(F.col("ts"), T.TimestampNTZType()).alias("ts"),
        fn.safe_cast(F.col("price_text"), T.IntegerType(), lenient=True)
        .isNull()
        .alias("not_an_integer"),
    )


@query("C4_default_value")
def _(t):
    return t.products.select(
        "product_id",
        fn.default_value(F.col("product_height_cm"), "unknown").alias("height"),
        fn.default_value(F.col("product_category_name"), "unknown").alias("category"),
    )


@query("C5_title_case")
def _(t):
    return t.table("documents").select("doc_id", fn.title_case(F.col("text")).alias("titled"))


@query("C6_upper_code")
def _(t):
    return t.customers.select(
        "customer_id", fn.upper_code(F.col("customer_state")).alias("state")
    )


@query("C7_month_bucket")
def _(t):
    return t.table("events").select(
        "event_id", fn.month_bucket(F.col("ts")).alias("event_month")
    )


@query("C8_days_between")
def _(t):
    start = F.lit("2024-01-15 12:34:56").cast("timestamp_ntz")
    return t.table("events").select(
        "event_id", fn.days_between(start, F.col("ts")).alias("days")
    )


@query("C9_whole_days")
def _(t):
    newest = joins.scalar_of(t.table("events"), F.max("ts"))
    return t.table("events").select(
        "event_id", fn.whole_days(F.col("ts"), newest).alias("days")
    )


@query("C10_months_elapsed")
def _(t):
    first = joins.scalar_of(t.table("orders"), F.min("o_orderdate"))
    return orders_with(t, months=fn.months_elapsed(first, F.col("o_orderdate")))


@query("C11_dow_hour")
def _(t):
    ts = F.col("ts")
    return t.table("events").select(
        "event_id",
        fn.day_of_week(ts).alias("day_of_week"),
        fn.hour_of_day(ts).alias("hour_of_day"),
    )


@query("C12_day_name")
def _(t):
    return orders_with(t, day_name=fn.day_name(fn.day_of_week(F.col("o_orderdate"))))


@query("C13_safe_ratio_pct")
def _(t):
    line = t.table("lineitem").groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast(AMOUNT))).alias("a"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast(AMOUNT))).alias("b"),
    )
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return line.select("l_orderkey", fn.safe_ratio_pct(a, b).alias("pct"))


@query("C13_ratio_of_long_decimals")
def _(t):
    """Operands with three and four decimals, and zero denominators."""
    line = t.table("lineitem")
    fine = F.col("l_extendedprice").cast("decimal(18,4)") / 1000
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax")).otherwise(0).cast("decimal(18,3)") / 10
    return line.select(
        "l_orderkey",
        "l_linenumber",
        fn.safe_ratio_pct(tax.cast("decimal(18,4)"), fine.cast("decimal(18,4)")).alias("pct"),
        fn.ratio(fine.cast("decimal(18,4)"), tax.cast("decimal(18,4)")).alias("quotient"),
    )


@query("C13_ratio_of_doubles")
def _(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", fn.ratio(F.col("l_tax"), F.col("l_discount")).alias("quotient")
    )


@query("C13_ratio_near_ties")
def _(t):
    """Quotients a hair below a tie, on one, and with more digits than a double has."""
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    below, tie, large = (F.lit(Decimal(x)) for x in ("0.00499999996", "0.005", "90071992547409931"))
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.ratio(number + below, F.lit(1)).alias("below"),
        fn.ratio(-(number + tie), F.lit(1)).alias("tie"),
        fn.ratio((number + below).cast("double"), F.lit(1)).alias("below_as_double"),
        fn.ratio(large + number, F.lit(100)).cast("string").alias("large"),
        fn.safe_ratio_pct(number, large).alias("small_pct"),
    )


@query("C14_late_flag")
def _(t):
    return t.orders.select(
        "order_id",
        fn.late_flag(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ).alias("is_late"),
    )


@query("C15_fault_flags")
def _(t):
    return analytics.delivery_milestones(t.star.fact_deliveries, t.orders, t.items).select(
        "order_id", "seller_id", "is_late", "is_seller_late", "is_carrier_late"
    )


@query("C16_display_label")
def _(t):
    return t.star.dim_products.select(
        "product_id", fn.display_label(F.col("category_english")).alias("label")
    )


@query("C17_route_label")
def _(t):
    return t.star.dim_sellers.select(
        "seller_id", fn.route_label(F.col("state"), F.col("city")).alias("route")
    )


# --- Joins ----------------------------------------------------------------


@query("J1_inner_join")
def _(t):
    return joins.skew_join(
        t.orders.select("order_id", "customer_id", "order_status"),
        t.customers.select("customer_id", "customer_unique_id"),
        "customer_id",
        spread=["order_id"],
    )


@query("J1_inner_join_salted")
def _(t):
    """The same join with a threshold low enough that most suppliers are salted."""
    lines = t.table("lineitem").select(
        F.col("l_suppkey").alias("seller_id"), "l_orderkey", "l_partkey", "l_linenumber"
    )
    joined = joins.skew_join(
        lines,
        t.sellers.select("seller_id", "seller_state"),
        "seller_id",
        spread=["l_orderkey", "l_partkey"],
        hot_rows=50,
    )
    return joined.groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_orderkey").alias("order_sum")
    )


@query("J2_composite_join")
def _(t):
    limits = t.items.groupBy("order_id", "seller_id").agg(
        F.max("shipping_limit_date").alias("shipping_limit")
    )
    return t.star.fact_deliveries.select("order_id", "seller_id", "is_late").join(
        limits, ["order_id", "seller_id"]
    )


@query("J3_join_aggregated")
def _(t):
    return joins.join_aggregated(
        t.orders.select("order_id", "order_status"),
        t.items,
        "order_id",
        [F.sum("price").alias("total_price"), F.count(F.lit(1)).alias("n_items")],
        defaults={"total_price": 0, "n_items": 0},
    )


@query("J4_spine_join")
def _(t):
    facts = t.star.fact_orders
    spine = facts.select(kpis.order_month()).distinct()
    counts = [
        facts.where(F.col("order_status") == status)
        .groupBy(kpis.order_month())
        .agg(F.count(F.lit(1)).alias(f"{status}_orders"))
        for status in ("delivered", "shipped", "canceled")
    ]
    return joins.spine_join(spine, "order_month", counts).fillna(0)


@query("J5_lookup_with_default")
def _(t):
    return joins.lookup_with_default(
        t.products.select("product_id", "product_category_name"),
        t.translation,
        "product_category_name",
        "product_category_name_english",
        "unknown",
    )


@query("J6_left_anti")
def _(t):
    return joins.without_match(t.orders.select("order_id", "customer_id"), t.items, ["order_id"])


@query("J7_not_exists")
def _(t):
    canceled = t.orders.where(F.col("order_status") == "canceled")
    return joins.without_match(
        t.customers.select("customer_id", "customer_state"), canceled, ["customer_id"]
    )


@query("J8_star_join")
def _(t):
    star = t.star
    tracked = star_plan.tracked_deliveries(t.orders, t.customers, t.items)
    milestones = analytics.with_faults(tracked)
    sellers = star.dim_sellers.select("seller_id", F.col("state").alias("seller_state"))
    people = star.dim_customers.select(
        "customer_unique_id", F.col("state").alias("customer_state")
    )
    return milestones.join(sellers, "seller_id").join(people, "customer_unique_id").select(
        "order_id",
        "seller_id",
        "seller_state",
        "customer_state",
        "carrier_handover_timestamp",
        "shipping_limit_timestamp",
        "is_seller_late",
        "is_carrier_late",
    )


@query("J9_scalar_subquery")
def _(t):
    facts = t.star.fact_orders
    newest = joins.scalar_of(facts, F.max("purchase_timestamp"))
    total = joins.scalar_of(facts, F.sum("total_payment"))
    return facts.select(
        "order_id",
        fn.whole_days(F.col("purchase_timestamp"), newest).alias("age_days"),
        fn.safe_ratio_pct(F.col("total_payment") * 1000, total).alias("share_per_mille_pct"),
    )


# --- Aggregation, distinct and windows -------------------------------------


@query("A1_hash_aggregate")
def _(t):
    quantity = F.col("l_quantity").cast(AMOUNT)
    price = F.col("l_extendedprice").cast(AMOUNT)
    return t.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(price).alias("sum_price"),
        fn.ratio(F.sum(quantity), F.count(quantity)).alias("avg_quantity"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query("A2_filtered_aggregate")
def _(t):
    return t.table("orders").groupBy(fn.month_bucket(F.col("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_delivered"),
        F.count_if(F.col("o_totalprice") > 250000).alias("n_large"),
    )


@query("A3_count_distinct")
def _(t):
    return t.table("orders").groupBy("o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("n_customers")
    )


@query("A4_count_non_null")
def _(t):
    return t.orders.groupBy("order_status").agg(
        F.count("order_delivered_carrier_date").alias("handed_over"),
        F.count("order_delivered_customer_date").alias("delivered"),
    )


@query("A5_having")
def _(t):
    per_customer = t.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return per_customer.where(F.col("n_orders") > 12)


@query("A6_select_distinct")
def _(t):
    return t.star.fact_orders.select("customer_unique_id", kpis.order_month()).distinct()


@query("A7_keep_latest")
def _(t):
    orders = t.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return dedupe.keep_latest(orders, ["o_custkey"], "o_orderdate")


@query("A8_keep_any")
def _(t):
    lines = t.table("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag")
    return dedupe.keep_any(lines, ["l_orderkey", "l_suppkey"])


@query("A9_group_by_ordinal")
def _(t):
    tables.register_views({"all_orders": t.table("orders")})
    return t.spark.sql(
        "SELECT CAST(trunc(o_orderdate, 'month') AS DATE) AS order_month, o_orderstatus, "
        "count(*) AS n_orders FROM all_orders GROUP BY 1, 2"
    )


@query("A10_nested_average")
def _(t):
    lines = t.table("lineitem").withColumn("quantity", F.col("l_quantity").cast(AMOUNT))
    return aggregates.nested_average(
        lines, "l_orderkey", "l_returnflag", F.col("quantity"), "avg_of_order_averages"
    )


@query("W1_lag")
def _(t):
    monthly = t.table("orders").groupBy(
        fn.month_bucket(F.col("o_orderdate")).alias("month")
    ).agg(F.count(F.lit(1)).alias("n_orders"))
    lagged = monthly.withColumn("previous_orders", series.previous("n_orders", "month"))
    return as_double(lagged, "previous_orders")


@query("W2_row_number")
def _(t):
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ranking.sequence_within(
        orders, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], "order_num"
    )


@query("W2_row_number_hot_keys")
def _(t):
    """The same ranking with busy sellers ranked by a distributed sort."""
    pairs = t.star.fact_deliveries.select("seller_id", "order_id", "purchase_timestamp")
    return ranking.sequence_within(
        pairs,
        ["seller_id"],
        [F.asc("purchase_timestamp"), F.asc("order_id")],
        "delivery_num",
        hot_rows=300,
    )


@query("W3_ntile")
def _(t):
    orders = t.table("orders").select("o_orderkey", F.col("o_totalprice"))
    key = F.asc("o_orderkey")
    return ranking.distributed_ntiles(
        orders, {"tile_asc": (4, [F.asc("o_totalprice"), key]), "tile_desc": (7, [F.desc("o_totalprice"), key])}
    )


@query("W4_share_of_total")
def _(t):
    grouped = t.star.fact_orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("total_payment").alias("revenue")
    )
    shared = series.share_of_total(grouped, "n_orders", "order_share_pct")
    return series.share_of_total(shared, "revenue", "revenue_share_pct")


@query("W5_rolling_sums")
def _(t):
    ceo = kpis.ceo_monthly(t.star.fact_orders).select(
        "order_month", "total_revenue", "total_orders"
    )
    rolled = series.rolling_sums(ceo, "order_month", ["total_revenue", "total_orders"])
    return as_double(rolled, "prior_ltm_total_orders")


# --- Sort, limit, set operations -------------------------------------------


@query("O1_order_by")
def _(t):
    return t.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate").orderBy(
        F.asc_nulls_last("o_orderstatus"), F.desc_nulls_first("o_orderdate"), "o_orderkey"
    )


@query("O1_places_in_order")
def _(t):
    """The same order as a column, so that a wrong one shows."""
    return ranking.global_position(
        t.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate"),
        [F.asc_nulls_last("o_orderstatus"), F.desc_nulls_first("o_orderdate"), F.asc("o_orderkey")],
        "place",
        marks=16,
    )


@query("O2_top_k")
def _(t):
    return series.top_rows(
        t.table("orders").select("o_orderkey", "o_totalprice"), 15, "o_totalprice", ["o_orderkey"]
    )


@query("O3_latest_rows")
def _(t):
    return series.top_rows(kpis.ceo_monthly(t.star.fact_orders), 10, "order_month", [])


@query("U1_union_all")
def _(t):
    placed = t.star.fact_orders.select("order_id", F.col("purchase_timestamp").alias("ts"))
    arrived = t.star.fact_orders.where(F.col("delivered_customer_timestamp").isNotNull()).select(
        "order_id", F.col("delivered_customer_timestamp").alias("ts")
    )
    return quality.union_all(
        [
            placed.withColumn("event", F.lit("placed")),
            arrived.withColumn("event", F.lit("arrived")),
        ]
    )


# --- Star schema and analytic plans ------------------------------------------


@query("P1_dim_customers")
def _(t):
    return t.star.dim_customers


@query("P2_dim_products")
def _(t):
    return as_double(t.star.dim_products, "weight_g", "length_cm", "height_cm", "width_cm")


@query("P3_dim_sellers")
def _(t):
    return t.star.dim_sellers


@query("P4_fact_orders")
def _(t):
    return t.star.fact_orders


@query("P5_fact_deliveries")
def _(t):
    return t.star.fact_deliveries


@query("P6_ceo_monthly")
def _ceo(t):
    return kpis.ceo_monthly(t.star.fact_orders)


@query("P7_ops_monthly")
def _ops(t):
    return kpis.ops_monthly(t.star.fact_deliveries)


@query("P8_marketing_monthly")
def _marketing(t):
    return kpis.marketing_monthly(t.star.fact_orders, t.reviews)


@query("P9_rfm_segmentation")
def _rfm(t):
    return analytics.rfm_segmentation(t.star.fact_orders)


@query("P10_rfm_summary")
def _(t):
    return analytics.rfm_summary(_rfm(t))


@query("P11_cohort_retention")
def _cohorts(t):
    return analytics.cohort_retention(t.star.fact_orders)


@query("P12_delivery_root_cause")
def _routes(t):
    star = t.star
    tracked = star_plan.tracked_deliveries(t.orders, t.customers, t.items)
    return analytics.delivery_root_cause(
        analytics.with_faults(tracked), star.dim_sellers, star.dim_customers
    )


@query("P13_worst_routes")
def _worst(t):
    return analytics.worst_routes(_routes(t), MIN_ROUTE_DELIVERIES)


@query("P13_worst_routes_top10")
def _(t):
    return analytics.worst_routes(_routes(t), MIN_ROUTE_DELIVERIES, limit=10)


@query("P14_time_patterns")
def _patterns(t):
    return analytics.time_patterns(t.event_orders, OTHER_EVENTS)


@query("P15_peak_hours")
def _(t):
    return analytics.peak_hours(_patterns(t))


@query("P16_weekday_distribution")
def _(t):
    return analytics.weekday_distribution(_patterns(t))


@query("P17_geo_revenue")
def _(t):
    return analytics.geo_revenue(t.star.fact_orders, t.star.dim_customers)


@query("P18_category_performance")
def _(t):
    star = t.star
    return analytics.category_performance(
        star.fact_orders, t.items, t.reviews, star.dim_products
    )


@query("P19_payment_trends")
def _trends(t):
    return analytics.payment_trends(t.star.fact_orders, t.payments)


# --- Dashboard figures ---------------------------------------------------------


@query("D1_ltm_growth")
def _(t):
    return as_double(dashboards.ltm_growth(_ceo(t)), "prior_ltm_orders")


@query("D2_aov_growth")
def _(t):
    return dashboards.aov_growth(_ceo(t))


@query("D2_aov_growth_exact")
def _(t):
    return dashboards.aov_growth(_ceo(t), rounded=False)


@query("D3_point_change_ops")
def _(t):
    return dashboards.ops_changes(_ops(t))


@query("D3_point_change_marketing")
def _(t):
    return dashboards.marketing_changes(_marketing(t))


@query("D4_acquisition_growth")
def _(t):
    return dashboards.acquisition_growth(_marketing(t))


@query("D4_acquisition_growth_at_least_one")
def _(t):
    return dashboards.acquisition_growth(_marketing(t), at_least_one=True)


@query("D5_active_month")
def _(t):
    return dashboards.active_month(_ceo(t), LAST_MONTH)


@query("D5_active_month_fallback")
def _(t):
    return dashboards.active_month(_ceo(t), dashboards.LAST_MONTH)


@query("D6_month_range")
def _(t):
    return dashboards.month_range(_ops(t), FIRST_MONTH, LAST_MONTH)


@query("D7_primary_driver")
def _(t):
    return _routes(t).select(
        "seller_state",
        "customer_state",
        fn.primary_driver(F.col("carrier_fault_share_pct")).alias("primary_driver"),
    )


@query("D8_cohort_curve")
def _(t):
    return dashboards.cohort_curve(_cohorts(t), COHORT)


@query("D9_payment_pivot")
def _(t):
    return dashboards.payment_pivot(
        dashboards.month_range(_trends(t), FIRST_MONTH, LAST_MONTH), FLAGS
    )


@query("D10_sla_trend")
def _(t):
    return dashboards.sla_trend(
        dashboards.month_range(_ops(t), FIRST_MONTH, LAST_MONTH), target_days=SLA_DAYS
    )


@query("D11_top_routes")
def _(t):
    return dashboards.top_routes(_worst(t), 8)


@query("D11_top_routes_five")
def _(t):
    return dashboards.top_routes(_worst(t), 5)


@query("D12_delta_direction")
def _(t):
    changes = dashboards.ops_changes(_ops(t))
    return changes.select(
        "order_month",
        fn.delta_direction(F.col("otd_pct_change")).alias("otd_direction"),
        fn.delta_direction(F.col("avg_delivery_days_change"), lower_is_better=True).alias(
            "days_direction"
        ),
    )
