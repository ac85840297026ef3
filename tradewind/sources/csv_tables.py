"""Header CSV files as all-text tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.csv_ranges import is_line_per_record, read_csv
from tradewind.sources.tables import replace_table

# File of each raw table, after the vendor's prefix.
RAW_CSV_TABLES = {
    "orders_dataset.csv": "raw_orders",
    "order_items_dataset.csv": "raw_order_items",
    "order_payments_dataset.csv": "raw_order_payments",
    "order_reviews_dataset.csv": "raw_order_reviews",
    "customers_dataset.csv": "raw_customers",
    "products_dataset.csv": "raw_products",
    "sellers_dataset.csv": "raw_sellers",
    "geolocation_dataset.csv": "raw_geolocation",
}
# Files that carry no prefix.
SHARED_CSV_TABLES = {"product_category_name_translation.csv": "raw_category_translation"}


def csv_tables(prefix: str = "") -> dict[str, str]:
    """File name to table name for a vendor's prefix."""
    return {f"{prefix}{name}": table for name, table in RAW_CSV_TABLES.items()} | SHARED_CSV_TABLES


def normalized(names: Iterable[str]) -> list[str]:
    """Trimmed, lower-case, underscored names; a byte-order mark is dropped.

    Names that become equal are reported instead of silently merged.
    """
    names = [c.lstrip("\ufeff").strip().lower().replace(" ", "_") for c in names]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"columns collide after normalisation: {repeated}")
    return names


def normalize_columns(df: DataFrame) -> DataFrame:
    """A frame with normalised column names, set by position."""
    return df.toDF(*normalized(df.columns))


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read a header CSV, or a folder of them; every column stays text.

    The header is read as it stands in the file, so repeated names are reported
    rather than renamed. All files at the path must have the same header: Spark
    compares each with the first and fails on another order or other names, as
    it would else join columns by position.

    ``multi_line`` admits quoted line breaks: files that hold one are read by byte ranges that
    find their records themselves (see :mod:`tradewind.sources.csv_ranges`), in three passes over
    the text. A search for the first quoted line break comes before, and files without one go
    to Spark's own reader. Files known to hold none take one pass if it is False.
    """
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    reader = {**options, "inferSchema": False, "multiLine": multi_line, "encoding": "UTF-8"}
    first = spark.read.csv(path, header=False, **reader).head()
    if first is None:
        raise ValueError(f"no header at {path}")
    names = normalized(c or "" for c in first)
    # Empty names and byte-order marks in a header are not for Spark's reader.
    plain = all(first) and not first[0].startswith("\ufeff")
    if multi_line and not (plain and is_line_per_record(spark, path)):
        header = [(c or "").lstrip("\ufeff") for c in first]
        return read_csv(spark, path, header, options).toDF(*names)
    reader["multiLine"] = False
    return spark.read.csv(path, header=True, enforceSchema=False, **reader).toDF(*names)


@dataclass(frozen=True)
class LoadResult:
    """Loaded tables and their row counts with a grand total."""

    tables: dict[str, DataFrame]
    counts: DataFrame | None
    missing: list[str]


def load_all(
    spark: SparkSession,
    folder: str,
    warehouse: str,
    prefix: str = "",
    table_map: Mapping[str, str] | None = None,
    splittable: Iterable[str] = (),
) -> LoadResult:
    """Load each CSV of ``table_map`` into a Parquet table below ``warehouse``.

    ``prefix`` is what the vendor puts before the file names. Missing files are
    skipped and named in the result. Tables named in ``splittable`` hold no
    quoted line breaks and are read in parallel within a file. Counts come from
    the written Parquet footers, not from a second pass over the text.
    """
    splittable = set(splittable)
    tables: dict[str, DataFrame] = {}
    missing: list[str] = []
    for file_name, table in (csv_tables(prefix) if table_map is None else table_map).items():
        try:
            raw = read_raw_csv(
                spark, f"{folder.rstrip('/')}/{file_name}", multi_line=table not in splittable
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(file_name)
            continue
        tables[table] = replace_table(raw, f"{warehouse.rstrip('/')}/{table}")
    counts = load_counts(tables) if tables else None
    return LoadResult(tables, counts, missing)


def load_counts(tables: Mapping[str, DataFrame], total_label: str = "TOTAL") -> DataFrame:
    """(table_name, row_count) per table plus the grand total."""
    each = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ],
    )
    # One row per table, so the roll-up to the total is a handful of rows.
    return each.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit(total_label)).alias("table_name"), "row_count"
    )
