"""Marketplace raw tables from an order, line item and event data set.

The mapping keeps the roles of the marketplace: an account (``customer``)
belongs to a person, here two accounts each; line items are sold by a
supplier; an order ships with its first accepted line and arrives with its
last one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.plans.star import StarSchema, build_star

AMOUNT = T.DecimalType(12, 2)
RATE = T.DecimalType(4, 2)

# Order states of the source and their marketplace names.
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "canceled"}
ESTIMATE_DAYS = 365

# Event types that are no purchase.
OTHER_EVENTS = ("click", "error", "signup", "view")


# Schemas of the source tables. Stating them saves the job that
# would read file footers to infer them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class RetailTables:
    """The tables of one folder in their marketplace roles.

    Its properties are named like the fields of ``RawTables``, so it can stand
    in for one; each table is planned when it is first used.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._read[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @cached_property
    def orders(self) -> DataFrame:
        """raw_orders: handover and arrival come from the order's lines."""
        lines = self.table("lineitem")
        accepted = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
        arrived = F.max(F.when(F.col("l_linestatus") == "F", 1)) == 1
        milestones = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(
            F.min(accepted).alias("order_delivered_carrier_date"),
            F.when(arrived, F.max("l_shipdate")).alias("order_delivered_customer_date"),
        )
        status = F.create_map(*[F.lit(x) for pair in STATUS_NAMES.items() for x in pair])
        placed = F.col("o_orderdate")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.element_at(status, F.col("o_orderstatus")).alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", placed).alias(
                "order_approved_at"
            ),
            (placed + F.make_dt_interval(F.lit(ESTIMATE_DAYS))).alias(
                "order_estimated_delivery_date"
            ),
        )
        return orders.join(milestones, "order_id", "left")

    @cached_property
    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(AMOUNT)
        days = F.make_dt_interval(F.col("l_quantity").cast("int"))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            (F.col("l_shipdate") - days).alias("shipping_limit_date"),
            price.alias("price"),
            (price * F.col("l_tax").cast(RATE)).cast(AMOUNT).alias("freight_value"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(AMOUNT)
        paid = price * (F.lit(1).cast(RATE) - F.col("l_discount").cast(RATE))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_returnflag").alias("payment_type"),
            paid.cast(AMOUNT).alias("payment_value"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).alias("review_score"),
        )

    def _states(self, key: str) -> DataFrame:
        """One row per nation, so that the left join is dropped where unused."""
        return (
            self.table("nation")
            .groupBy(F.col("n_nationkey").alias(key))
            .agg(F.lower(F.min("n_name")).alias("state"))
        )

    @cached_property
    def customers(self) -> DataFrame:
        located = self.table("customer").join(self._states("c_nationkey"), "c_nationkey", "left")
        return located.select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey div 2").alias("customer_unique_id"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
            F.concat(F.lit("porto d'"), F.lower("c_mktsegment")).alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        located = self.table("supplier").join(self._states("s_nationkey"), "s_nationkey", "left")
        return located.select(
            F.col("s_suppkey").alias("seller_id"),
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.lower("s_name").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        brand = F.col("p_brand")
        size = F.col("p_size").cast("string")
        category = F.when(brand == "Brand#1", "").when(brand != "Brand#2", F.col("p_type"))
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            category.alias("product_category_name"),
            size.alias("product_weight_g"),
            F.when(brand == "Brand#3", "").otherwise(size).alias("product_length_cm"),
            F.when(brand != "Brand#4", size).alias("product_height_cm"),
            F.col("p_retailprice").cast("int").cast("string").alias("product_width_cm"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """A name for every part type; one is filed under another spelling and stays unmatched."""
        spelled = F.when(F.col("p_type") == "ECONOMY", "ECONOMY CLASS").otherwise(F.col("p_type"))
        return (
            self.table("part")
            .select(spelled.alias("product_category_name"))
            .distinct()
            .withColumn(
                "product_category_name_english",
                F.concat(F.lower("product_category_name"), F.lit("_goods")),
            )
        )

    @cached_property
    def star(self) -> StarSchema:
        return build_star(self)

    @cached_property
    def event_orders(self) -> DataFrame:
        """Events as orders, for figures that need a time of day."""
        return self.table("events").select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_unique_id"),
            F.col("event_type").alias("order_status"),
            F.col("ts").alias("purchase_timestamp"),
            F.col("value").cast(AMOUNT).alias("total_payment"),
        )


Query = Callable[[SparkSession, str], DataFrame]
