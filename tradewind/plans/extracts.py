"""Named views and the extracts that feed the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.plans import analytics, kpis
from tradewind.plans.star import RawTables, StarSchema, open_star
from tradewind.sources.tables import export_json, published_version, register_views


def analytic_views(star: StarSchema, raw: RawTables) -> dict[str, DataFrame]:
    """The analytic views by name. Names are fixed values."""
    return {
        "view_ceo_monthly_kpis": kpis.ceo_monthly(star.fact_orders),
        "view_ops_monthly_kpis": kpis.ops_monthly(star.fact_deliveries),
        "view_marketing_monthly_kpis": kpis.marketing_monthly(star.fact_orders, raw.reviews),
        "view_rfm_segmentation": analytics.rfm_segmentation(star.fact_orders),
        "view_cohort_retention": analytics.cohort_retention(star.fact_orders),
        "view_delivery_root_cause": analytics.delivery_root_cause(
            analytics.delivery_milestones(star.fact_deliveries, raw.orders, raw.items),
            star.dim_sellers,
            star.dim_customers,
        ),
        "view_time_patterns": analytics.time_patterns(star.fact_orders),
    }


def register_star(star: StarSchema, raw: RawTables) -> dict[str, DataFrame]:
    """Make the star tables and the analytic views queryable by name."""
    views = analytic_views(star, raw)
    register_views({**star.tables(), **views})
    return views


class LiveViews:
    """The star tables and analytic views of a folder, which follow what is published there.

    The plans hold no copies of data. ``follow`` looks at the folder's version, one
    listing, and registers the views anew when it has changed: as temporary views of the
    session, and for all sessions of the application as ``global_temp.<name>``.
    """

    def __init__(self, spark: SparkSession, folder: str, raw: RawTables):
        self.spark, self.folder, self.raw = spark, folder, raw
        self.version = 0
        self.views: dict[str, DataFrame] = {}

    def follow(self) -> bool:
        """Whether there was something new."""
        version = published_version(self.spark, self.folder.rstrip("/"))
        if version == self.version:
            return False
        star = open_star(self.spark, self.folder)
        self.views = analytic_views(star, self.raw)
        register_views({**star.tables(), **self.views}, everywhere=True)
        self.version = version
        return True

    def sql(self, query: str) -> DataFrame:
        """The query over the views as they are now."""
        self.follow()
        return self.spark.sql(query)


def extracts(
    star: StarSchema,
    raw: RawTables,
    views: dict[str, DataFrame] | None = None,
    min_route_deliveries: int = 100,
) -> dict[str, DataFrame]:
    """The ten dashboard extracts, each in its published order."""
    views = views or analytic_views(star, raw)
    return {
        "ceo_monthly": views["view_ceo_monthly_kpis"],
        "ops_monthly": views["view_ops_monthly_kpis"],
        "marketing_monthly": views["view_marketing_monthly_kpis"],
        "rfm_summary": analytics.rfm_summary(views["view_rfm_segmentation"]),
        "cohort_retention": views["view_cohort_retention"],
        "delivery_root_cause": analytics.worst_routes(
            views["view_delivery_root_cause"], min_route_deliveries
        ),
        "time_patterns": views["view_time_patterns"],
        "geo_revenue": analytics.geo_revenue(star.fact_orders, star.dim_customers),
        "category_performance": analytics.category_performance(
            star.fact_orders, raw.items, raw.reviews, star.dim_products
        ),
        "payment_trends": analytics.payment_trends(star.fact_orders, raw.payments),
    }


def export_extracts(frames: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every extract below ``folder`` and return the paths.

    Extracts hold months, weekday hours, segments, routes or top lists, so
    each fits in one file.
    """
    paths = {name: f"{folder.rstrip('/')}/{name}.json" for name in frames}
    for name, frame in frames.items():
        export_json(frame, paths[name], single_file=True)
    return paths
