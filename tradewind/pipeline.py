"""From raw CSV files to star schema, views and extracts.

    python -m tradewind.pipeline --csv FOLDER --out FOLDER
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans.extracts import export_extracts, extracts, register_star
from tradewind.plans.star import RawTables, StarSchema, build_star, write_star
from tradewind.session import spark_session
from tradewind.sources.csv_tables import LoadResult, load_all

# Raw tables without free text, whose files Spark may split.
TABLES_WITHOUT_LINE_BREAKS = (
    "raw_orders",
    "raw_order_items",
    "raw_order_payments",
    "raw_customers",
    "raw_products",
    "raw_sellers",
    "raw_geolocation",
    "raw_category_translation",
)


@dataclass(frozen=True)
class PipelineResult:
    loaded: LoadResult
    star: StarSchema
    views: dict[str, DataFrame]
    extract_paths: dict[str, str]


def run(
    spark: SparkSession,
    csv_folder: str,
    out_folder: str,
    prefix: str = "",
    splittable: Iterable[str] = TABLES_WITHOUT_LINE_BREAKS,
) -> PipelineResult:
    """Load, model, check, and export. Running it again replaces every table."""
    out = out_folder.rstrip("/")
    loaded = load_all(spark, csv_folder, f"{out}/raw", prefix, splittable=splittable)
    raw = RawTables.from_loaded(loaded.tables)
    star = write_star(build_star(raw), f"{out}/star")
    views = register_star(star, raw)
    paths = export_extracts(extracts(star, raw, views), f"{out}/extracts")
    return PipelineResult(loaded, star, views, paths)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True, help="folder with the raw CSV files")
    parser.add_argument("--out", required=True, help="folder for tables and extracts")
    parser.add_argument("--prefix", default="", help="what the vendor puts before the file names")
    parser.add_argument("--master", default=None)
    options = parser.parse_args()
    spark = spark_session(master=options.master)
    result = run(spark, options.csv, options.out, options.prefix)
    result.loaded.counts.show(truncate=False)
    for name in result.loaded.missing:
        print(f"missing: {name}")
    spark.stop()


if __name__ == "__main__":
    main()
