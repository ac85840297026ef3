"""Star schema: three dimensions and two facts, built from raw tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import (
    days_between,
    default_value,
    late_flag,
    month_bucket,
    title_case,
    typed,
    upper_code,
)
from tradewind.operators import quality
from tradewind.operators.dedupe import insert_if_absent, keep_any, keep_latest
from tradewind.operators.joins import lookup_with_default
from tradewind.sources.tables import publish_tables, published_tables, replace_table

TIMESTAMP = T.TimestampNTZType()
# Amounts of single rows as they come in. Sums keep all six decimals and are
# rounded once, when the fact is built.
MONEY_IN = T.DecimalType(22, 6)
MONEY = T.DecimalType(18, 2)

# Order states whose parcels are tracked.
TRACKED_STATUSES = ("delivered", "shipped")

# Categories the translation file lacks.
MISSING_TRANSLATIONS = (
    (
        "portateis_cozinha_e_preparadores_de_alimentos",
        "portable_kitchen_and_food_processors",
    ),
    ("pc_gamer", "pc_gamer"),
)


@dataclass(frozen=True)
class RawTables:
    """The raw tables a star schema is built from."""

    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    translation: DataFrame

    @classmethod
    def from_loaded(cls, tables: Mapping[str, DataFrame]) -> RawTables:
        """From tables keyed by their raw names, as ``load_all`` returns them."""
        names = {
            "orders": "raw_orders",
            "items": "raw_order_items",
            "payments": "raw_order_payments",
            "reviews": "raw_order_reviews",
            "customers": "raw_customers",
            "products": "raw_products",
            "sellers": "raw_sellers",
            "translation": "raw_category_translation",
        }
        lacking = sorted(name for name in names.values() if name not in tables)
        if lacking:
            raise ValueError(f"the star schema needs tables that were not loaded: {lacking}")
        return cls(**{field: tables[name] for field, name in names.items()})


STAR_TABLES = (
    "dim_products",
    "dim_customers",
    "dim_sellers",
    "fact_orders",
    "fact_deliveries",
)


class StarSchema:
    """The five star tables, each built when it is first asked for.

    Building a DataFrame plans its joins, so a report that reads one fact does
    not pay for the other tables.
    """

    def __init__(self, **builders: Callable[[], DataFrame]):
        if set(builders) != set(STAR_TABLES):
            raise ValueError(f"a star schema needs exactly {STAR_TABLES}")
        self._builders = builders

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise AttributeError(name)
        table = self._builders[name]()
        setattr(self, name, table)
        return table

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAR_TABLES}


def clean_translations(
    translation: DataFrame, rows: Sequence[tuple[str, str]] = MISSING_TRANSLATIONS
) -> DataFrame:
    """Add the translations the delivered file lacks."""
    known = translation.select("product_category_name", "product_category_name_english")
    return insert_if_absent(known, rows, "product_category_name")


def dim_customers(raw_customers: DataFrame) -> DataFrame:
    """One row per person; the address of the highest customer_id wins."""
    source = raw_customers.select(
        "customer_unique_id",
        "customer_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        "customer_city",
        "customer_state",
    )
    latest = keep_latest(source, ["customer_unique_id"], "customer_id")
    return latest.select(
        "customer_unique_id",
        "zip_code_prefix",
        title_case(F.col("customer_city")).alias("city"),
        upper_code(F.col("customer_state")).alias("state"),
    )


def dim_sellers(raw_sellers: DataFrame) -> DataFrame:
    source = raw_sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        "seller_city",
        "seller_state",
    )
    return keep_any(source, ["seller_id"]).select(
        "seller_id",
        "zip_code_prefix",
        title_case(F.col("seller_city")).alias("city"),
        upper_code(F.col("seller_state")).alias("state"),
    )


def dim_products(
    raw_products: DataFrame, translation: DataFrame, unknown: str = "unknown"
) -> DataFrame:
    """Products with English category and integer measurements."""
    named = lookup_with_default(
        raw_products,
        translation,
        "product_category_name",
        "product_category_name_english",
        unknown,
    )
    measures = {
        "weight_g": "product_weight_g",
        "length_cm": "product_length_cm",
        "height_cm": "product_height_cm",
        "width_cm": "product_width_cm",
    }
    return named.select(
        "product_id",
        F.col("product_category_name_english").alias("category_english"),
        *[typed(named, raw, T.IntegerType()).alias(name) for name, raw in measures.items()],
    )


def _with_person(orders: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """Orders of known customers, with the person behind the account.

    A plain join: Spark broadcasts the accounts if they are few, and splits an
    account with very many orders at run time.
    """
    accounts = raw_customers.select("customer_id", "customer_unique_id")
    return orders.join(accounts, "customer_id").drop("customer_id")


def fact_orders(
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    raw_items: DataFrame,
    raw_payments: DataFrame,
    money: T.DecimalType = MONEY,
    money_in: T.DecimalType = MONEY_IN,
) -> DataFrame:
    """One row per order with item, freight and payment totals.

    Items and payments are summed per order before they are joined, so an
    order with several of each keeps one row and its true totals.
    """
    items = raw_items.groupBy("order_id").agg(
        F.sum(typed(raw_items, "price", money_in)).alias("total_price"),
        F.sum(typed(raw_items, "freight_value", money_in)).alias("total_freight"),
    )
    payments = raw_payments.groupBy("order_id").agg(
        F.sum(typed(raw_payments, "payment_value", money_in)).alias("total_payment")
    )
    times = {
        "purchase_timestamp": "order_purchase_timestamp",
        "approved_timestamp": "order_approved_at",
        "delivered_carrier_timestamp": "order_delivered_carrier_date",
        "delivered_customer_timestamp": "order_delivered_customer_date",
        "estimated_delivery_timestamp": "order_estimated_delivery_date",
    }
    orders = raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        *[typed(raw_orders, raw, TIMESTAMP).alias(name) for name, raw in times.items()],
    )
    # People first, while the rows are narrow; the totals then leave the fact
    # partitioned by order_id, which is what it is joined on next.
    known = _with_person(orders, raw_customers)
    return (
        known.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .select(
            "order_id",
            "customer_unique_id",
            "order_status",
            *times,
            *[
                default_value(F.col(c), 0).cast(money).alias(c)
                for c in ("total_price", "total_freight", "total_payment")
            ],
        )
    )


def tracked_deliveries(
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    raw_items: DataFrame,
    statuses: Sequence[str] = TRACKED_STATUSES,
    day_precision: int = 9,
) -> DataFrame:
    """The delivery fact with each parcel's handover and shipping limit.

    Items are read once: an order's items are grouped per seller, which gives
    both the pairs and their latest limit. Everything else follows from the
    order, so no row needs removing afterwards. Order and account ids must be
    unique, which the star build checks. A limit that is not asked for is not
    computed.
    """
    shipped = raw_orders.where(F.col("order_status").isin(*statuses))
    orders = shipped.select(
        "order_id",
        "customer_id",
        typed(shipped, "order_purchase_timestamp", TIMESTAMP).alias("purchase_timestamp"),
        typed(shipped, "order_delivered_customer_date", TIMESTAMP).alias(
            "delivered_customer_timestamp"
        ),
        typed(shipped, "order_estimated_delivery_date", TIMESTAMP).alias(
            "estimated_delivery_timestamp"
        ),
        typed(shipped, "order_delivered_carrier_date", TIMESTAMP).alias(
            "carrier_handover_timestamp"
        ),
    )
    # The greatest value as delivered, cast afterwards: for ISO text the latest.
    pairs = raw_items.groupBy("order_id", "seller_id").agg(
        F.max("shipping_limit_date").alias("shipping_limit_date")
    )
    pairs = pairs.select(
        "order_id",
        "seller_id",
        typed(pairs, "shipping_limit_date", TIMESTAMP).alias("shipping_limit_timestamp"),
    )
    purchased = F.col("purchase_timestamp")
    delivered = F.col("delivered_customer_timestamp")
    estimated = F.col("estimated_delivery_timestamp")

    def days(start, end):
        return days_between(start, end, day_precision)

    return (
        _with_person(orders, raw_customers)
        .join(pairs, "order_id")
        .select(
            "order_id",
            "seller_id",
            "customer_unique_id",
            purchased,
            delivered,
            estimated,
            days(purchased, delivered).alias("actual_delivery_days"),
            days(purchased, estimated).alias("estimated_delivery_days"),
            days(estimated, delivered).alias("days_difference"),
            late_flag(delivered, estimated).alias("is_late"),
            "carrier_handover_timestamp",
            "shipping_limit_timestamp",
        )
    )


MILESTONES = ("carrier_handover_timestamp", "shipping_limit_timestamp")


def fact_deliveries(
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    raw_items: DataFrame,
    statuses: Sequence[str] = TRACKED_STATUSES,
    day_precision: int = 9,
) -> DataFrame:
    """One row per order and seller for shipped and delivered orders."""
    tracked = tracked_deliveries(raw_orders, raw_customers, raw_items, statuses, day_precision)
    return tracked.drop(*MILESTONES)


def build_star(raw: RawTables) -> StarSchema:
    """All five tables, from raw ones."""
    return StarSchema(
        dim_customers=lambda: dim_customers(raw.customers),
        dim_products=lambda: dim_products(raw.products, clean_translations(raw.translation)),
        dim_sellers=lambda: dim_sellers(raw.sellers),
        fact_orders=lambda: fact_orders(raw.orders, raw.customers, raw.items, raw.payments),
        fact_deliveries=lambda: fact_deliveries(raw.orders, raw.customers, raw.items),
    )


def star_checks(
    star: StarSchema,
    max_lengths: Mapping[str, Mapping[str, int]] | None = None,
    max_numbers: Mapping[str, Mapping[str, float]] | None = None,
) -> dict[str, DataFrame]:
    """Primary keys, foreign keys, required columns and value bounds.

    Each entry holds the violations of one constraint; all should be empty.
    """
    lengths = max_lengths if max_lengths is not None else DEFAULT_LENGTHS
    numbers = max_numbers if max_numbers is not None else DEFAULT_NUMBERS
    tables = star.tables()
    checks = {
        f"{name} primary key": quality.check_unique(tables[name], keys)
        for name, keys in PRIMARY_KEYS.items()
    }
    checks |= {
        f"{name} required columns": quality.check_not_null(tables[name], columns)
        for name, columns in REQUIRED.items()
    }
    checks |= {
        f"{fact} to {dimension}": quality.check_foreign_key(
            tables[fact], key, tables[dimension], key
        )
        for fact, key, dimension in FOREIGN_KEYS
    }
    checks |= {
        f"{name} domain": quality.check_domain(
            tables[name], max_length=lengths.get(name), max_abs=numbers.get(name)
        )
        for name in {**lengths, **numbers}
    }
    return checks


PRIMARY_KEYS = {
    "dim_customers": ["customer_unique_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "fact_orders": ["order_id"],
    "fact_deliveries": ["order_id", "seller_id"],
}

REQUIRED = {
    "dim_customers": ["customer_unique_id", "zip_code_prefix", "city", "state"],
    "dim_products": ["product_id", "category_english"],
    "dim_sellers": ["seller_id", "zip_code_prefix", "city", "state"],
    "fact_orders": [
        "order_id",
        "customer_unique_id",
        "order_status",
        "purchase_timestamp",
        "estimated_delivery_timestamp",
    ],
    "fact_deliveries": [
        "order_id",
        "seller_id",
        "customer_unique_id",
        "purchase_timestamp",
        "estimated_delivery_timestamp",
    ],
}

FOREIGN_KEYS = [
    ("fact_orders", "customer_unique_id", "dim_customers"),
    ("fact_deliveries", "customer_unique_id", "dim_customers"),
    ("fact_deliveries", "seller_id", "dim_sellers"),
]

# Declared text lengths.
DEFAULT_LENGTHS = {
    "dim_customers": {"customer_unique_id": 50, "zip_code_prefix": 10, "city": 100, "state": 2},
    "dim_products": {"product_id": 50, "category_english": 100},
    "dim_sellers": {"seller_id": 50, "zip_code_prefix": 10, "city": 100, "state": 2},
    "fact_orders": {"order_id": 50, "order_status": 20},
    "fact_deliveries": {"order_id": 50},
}

# Greatest numbers of the declared decimals, ten digits with two
# decimals for money and five with two for days.
DEFAULT_NUMBERS = {
    "fact_orders": {"total_price": 99999999.99, "total_freight": 99999999.99, "total_payment": 99999999.99},
    "fact_deliveries": {
        "actual_delivery_days": 999.99,
        "estimated_delivery_days": 999.99,
        "days_difference": 999.99,
    },
}


def written_star(tables: Mapping[str, DataFrame]) -> StarSchema:
    """A star schema over tables that already exist."""
    return StarSchema(**{name: (lambda df=df: df) for name, df in tables.items()})


def write_star(
    star: StarSchema,
    folder: str,
    max_lengths: Mapping[str, Mapping[str, int]] | None = None,
    max_numbers: Mapping[str, Mapping[str, float]] | None = None,
) -> StarSchema:
    """Write the five tables, check them, and only then put them in place.

    Facts are partitioned by purchase month, so monthly reads prune files. The
    tables are written beside the published ones and the constraints checked
    there, so the star is computed once and a build that fails leaves the last
    good star as it was. All five become current by one rename.
    """
    target = folder.rstrip("/")
    staging = f"{target}/_staging/{uuid.uuid4().hex}"
    spark = star.fact_orders.sparkSession
    written = {}
    for name, df in star.tables().items():
        path = f"{staging}/{name}"
        if name.startswith("fact_"):
            dated = df.withColumn("purchase_month", month_bucket(F.col("purchase_timestamp")))
            written[name] = replace_table(dated, path, partition_by=["purchase_month"])
        else:
            written[name] = replace_table(df, path, rebalance=True)
    quality.enforce(star_checks(written_star(written), max_lengths, max_numbers))
    publish_tables(spark, target, {name: f"{staging}/{name}" for name in written})
    return open_star(spark, target)


def open_star(spark: SparkSession, folder: str) -> StarSchema:
    """The star that was last published in a folder."""
    paths = published_tables(spark, folder)
    lacking = sorted(set(STAR_TABLES) - set(paths))
    if lacking:
        raise ValueError(f"no star schema is published in {folder}: {lacking} are missing")
    return StarSchema(**{name: (lambda at=paths[name]: spark.read.parquet(at)) for name in STAR_TABLES})
