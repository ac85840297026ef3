"""Tables that are published together, views that follow them, and lazy plans."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tradewind.operators import ranking
from tradewind.plans.extracts import LiveViews, analytic_views
from tradewind.plans.star import RawTables, build_star, open_star, write_star
from tradewind.sources import tables
from tradewind.sources.retail_tables import RetailTables

NAMES = ("a", "b", "c")


class Crash(Exception):
    pass


def staged(spark, folder, value):
    paths = {name: f"{folder}/_staging/{value}/{name}" for name in NAMES}
    for path in paths.values():
        tables.replace_table(spark.range(1).select(F.lit(value).alias("v")), path)
    return paths


def current(spark, folder):
    return {name: spark.read.parquet(path).first()["v"] for name, path in tables.published_tables(spark, folder).items()}


def test_a_crash_at_any_step_leaves_one_publication(spark, tmp_path):
    folder = str(tmp_path / "count")
    steps = []
    for value in (1, 2, 3):
        steps.clear()
        tables.publish_tables(spark, folder, staged(spark, folder, value), steps.append)
    assert len(steps) == 9 and current(spark, folder) == dict.fromkeys(NAMES, 3)

    for crash_at in range(len(steps)):
        folder = str(tmp_path / f"crash{crash_at}")
        for value in (1, 2):
            tables.publish_tables(spark, folder, staged(spark, folder, value))
        seen = []

        def fail(step):
            if len(seen) == crash_at:
                raise Crash(step)
            seen.append(step)

        with pytest.raises(Crash):
            tables.publish_tables(spark, folder, staged(spark, folder, 3), fail)
        expected = 3 if steps[crash_at] == "done" else 2
        assert current(spark, folder) == dict.fromkeys(NAMES, expected)
        tables.publish_tables(spark, folder, staged(spark, folder, 4))
        assert current(spark, folder) == dict.fromkeys(NAMES, 4)


def test_two_writers_of_one_version(spark, tmp_path):
    folder = str(tmp_path)
    tables.publish_tables(spark, folder, staged(spark, folder, 1))
    second = staged(spark, folder, 2)

    def overtake(step):
        if step == "publish":
            tables.replace_table(spark.range(1).select(F.lit(9).alias("v")), f"{folder}/x")
            (tmp_path / "_published" / "000002.json").write_text("{}")

    with pytest.raises(Exception, match="another writer|exists"):
        tables.publish_tables(spark, folder, second, overtake)


def raw_tables(spark, keep="true"):
    t = RetailTables(spark, SMALL)
    return RawTables(
        orders=t.orders.where(keep), items=t.items, payments=t.payments, reviews=t.reviews,
        customers=t.customers, products=t.products, sellers=t.sellers, translation=t.translation,
    )


def plain(df):
    return sorted(map(str, df.collect()))


def test_views_follow_the_star_in_every_session(spark, tmp_path):
    folder = str(tmp_path)
    few = raw_tables(spark, "order_id % 2 = 0")
    write_star(build_star(few), folder, {}, {})
    live = LiveViews(spark, folder, few)
    names = list(analytic_views(open_star(spark, folder), few))
    query = "SELECT * FROM view_rfm_segmentation"
    before = live.sql(query).count()
    assert not live.follow()
    write_star(build_star(raw_tables(spark)), folder, {}, {})
    live.raw = raw_tables(spark)
    assert live.sql(query).count() > before
    fresh = analytic_views(open_star(spark, folder), live.raw)
    other = spark.newSession()
    for name in names:
        expected = plain(fresh[name])
        assert plain(spark.table(name)) == expected
        assert plain(other.table(f"global_temp.{name}")) == expected


def test_views_see_a_source_that_is_overwritten_in_place(spark, tmp_path):
    path = str(tmp_path / "source")
    rows = lambda n: spark.range(n).select("id", (F.col("id") % 7).alias("v"))
    source = tables.replace_table(rows(10), path)
    tiled = ranking.distributed_ntile(source, 3, [F.desc("v"), F.asc("id")], "t")
    tables.register_views({"tiled_source": tiled})
    assert spark.table("tiled_source").count() == 10
    tables.replace_table(rows(40), path)
    tables.refresh_views(spark, ["tiled_source"])
    expected = rows(40).withColumn("t", F.ntile(3).over(Window.orderBy(F.desc("v"), "id")))
    assert plain(spark.table("tiled_source")) == plain(expected)


@pytest.mark.parametrize("value", ["id % 50", "7", "if(id % 3 = 0, NULL, -id % 11)", "double(id) / 7"])
@pytest.mark.parametrize("marks", [4, 300])
def test_tiles_and_positions_for_any_marks(spark, value, marks):
    df = spark.range(15_000).select("id", F.expr(value).alias("v"))
    for order in ([F.desc_nulls_first("v"), F.asc("id")], [F.asc_nulls_last("v"), F.desc("id")]):
        mine = ranking.distributed_ntiles(df, {"t": (4, order), "u": (37, order)}, marks)
        window = Window.orderBy(*order)
        expected = df.withColumns({"t": F.ntile(4).over(window), "u": F.ntile(37).over(window)})
        assert mine.exceptAll(expected).isEmpty() and mine.count() == 15_000


def test_no_job_runs_while_a_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plan building")
    try:
        t = RetailTables(spark, SMALL)
        before = len(tracker.getJobIdsForGroup("plans"))
        df = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
        ranking.distributed_ntile(df, 4, order, "t")
        ranking.global_position(df, order, "n")
        ranking.sequence_within(df, ["o_custkey"], order, "n", 100)
        assert len(tracker.getJobIdsForGroup("plans")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
