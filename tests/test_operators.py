"""Operators against brute force, with thresholds low enough to hit hot keys."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.operators import aggregates, dedupe, joins, quality, ranking, series


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def by_text(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third share key 0, some keys are NULL, the rest are spread."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") < 1000, F.lit(0))
        .when(F.col("id") < 1100, F.lit(None))
        .otherwise(F.col("id") % 97)
        .cast("long")
        .alias("k"),
        (F.col("id") * 7919 % 1009).alias("v"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [5, 100, 10_000])
def test_skew_join_equals_plain_join(spark, skewed, how, hot_rows):
    dimension = spark.range(0, 90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    joined = joins.skew_join(skewed, dimension, "k", ["id"], how, hot_rows)
    plain = skewed.join(dimension, "k", how)
    assert joined.columns == plain.columns
    assert by_text(joined) == by_text(plain)


def test_skew_join_keeps_duplicate_dimension_rows(spark, skewed):
    dimension = spark.range(0, 40).select((F.col("id") % 20).alias("k"), F.col("id").alias("d"))
    joined = joins.skew_join(skewed, dimension, "k", ["id"], "inner", 50)
    assert by_text(joined) == by_text(skewed.join(dimension, "k"))


def test_skew_join_spreads_the_hot_key(spark, skewed):
    """No (key, salt) group holds much more than the threshold."""
    joined = joins.skew_join(
        skewed, spark.range(97).select(F.col("id").alias("k")), "k", ["id"], "inner", 100
    )
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    salted = skewed.where("k = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(10))).count()
    assert salted.agg(F.max("count")).first()[0] < 150


def test_skew_join_counts_from_other_table(spark, skewed):
    dimension = spark.range(97).select(F.col("id").alias("k"), F.col("id").alias("d"))
    doubled = skewed.union(skewed)
    joined = joins.skew_join(skewed, dimension, "k", ["id"], "inner", 100, counts_from=doubled)
    assert by_text(joined) == by_text(skewed.join(dimension, "k"))


def test_skew_join_rejects_other_kinds(skewed):
    with pytest.raises(ValueError):
        joins.skew_join(skewed, skewed, "k", ["id"], "full")


def test_join_aggregated_keeps_row_count(values):
    orders = values("o int", "(1), (2), (3)")
    items = values("o int, p int", "(1, 10), (1, 20), (1, 30), (2, 5)")
    joined = joins.join_aggregated(
        orders, items, "o", [F.sum("p").alias("t")], defaults={"t": 0}
    )
    assert rows(joined) == [(1, 60), (2, 5), (3, 0)]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(size=st.integers(0, 60), tiles=st.integers(1, 9), spread=st.integers(1, 30))
def test_distributed_ntile_equals_window(spark, size, tiles, spread):
    df = spark.range(size).select(
        F.col("id"), F.pmod(F.xxhash64("id"), F.lit(spread)).alias("v")
    )
    order = [F.desc("v"), F.asc("id")]
    mine = ranking.distributed_ntile(df, tiles, order, "t")
    expected = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    assert rows(mine) == rows(expected)


def test_ntile_with_one_dominant_value(spark):
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("v")
    )
    order = [F.asc("v"), F.asc("id")]
    mine = ranking.distributed_ntile(df, 4, order, "t")
    expected = df.withColumn("t", F.ntile(4).over(Window.orderBy(*order)))
    assert mine.exceptAll(expected).isEmpty() and expected.exceptAll(mine).isEmpty()


def test_global_position(spark):
    df = spark.range(5000).select("id", F.pmod(F.xxhash64("id"), F.lit(13)).alias("v"))
    placed = ranking.global_position(df, [F.asc("v"), F.asc("id")], "n")
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("long"))
    assert rows(placed) == rows(expected)


@pytest.mark.parametrize("hot_rows", [20, 500, 100_000])
def test_sequence_within_equals_window(skewed, hot_rows):
    order = [F.asc("v"), F.asc("id")]
    mine = ranking.sequence_within(skewed, ["k"], order, "n", hot_rows)
    window = Window.partitionBy("k").orderBy(*order)
    expected = skewed.withColumn("n", F.row_number().over(window).cast("long"))
    assert by_text(mine) == by_text(expected)


def test_keep_latest(values):
    df = values(
        "u int, id string, city string",
        "(1, 'a', 'x'), (1, 'c', 'y'), (1, 'b', NULL), (2, 'a', NULL), "
        "(3, NULL, 'n'), (3, 'z', 'o')",
    )
    kept = dedupe.keep_latest(df, ["u"], "id")
    assert by_text(kept) == [(1, "c", "y"), (2, "a", None), (3, None, "n")]


def test_keep_any_is_one_whole_row(values):
    df = values("k int, a int, b string", "(1, 2, 'x'), (1, 1, 'y'), (1, 1, 'z'), (2, NULL, 'q')")
    assert by_text(dedupe.keep_any(df, ["k"])) == [(1, 1, "y"), (2, None, "q")]
    assert rows(dedupe.keep_any(df.select("k"), ["k"])) == [(1,), (2,)]


def test_insert_if_absent_twice(values):
    existing = values("k string, v string", "('a', 'A'), ('b', 'B'), ('b', 'B2')")
    added = [("b", "other"), ("c", "C")]
    once = dedupe.insert_if_absent(existing, added, "k")
    assert rows(once) == [("a", "A"), ("b", "B"), ("b", "B2"), ("c", "C")]
    assert rows(dedupe.insert_if_absent(once, added, "k")) == rows(once)


def test_lookup_and_anti_join(values):
    left = values("id int, k string", "(1, 'a'), (2, 'b'), (3, NULL), (4, 'a')")
    names = values("k string, name string", "('a', 'A'), ('c', 'C')")
    found = joins.lookup_with_default(left, names, "k", "name", "?")
    assert rows(found.select("id", "name")) == [(1, "A"), (2, "?"), (3, "?"), (4, "A")]
    unmatched = joins.without_match(left, names.union(names), ["k"])
    assert rows(unmatched.select("id")) == [(2,), (3,)]


def test_quality_checks(values):
    df = values(
        "id int, name string, amount decimal(8)",
        "(1, 'x', 5), (1, 'long', -1200), (2, NULL, 0), (NULL, '', 3), (NULL, 'y', 4)",
    )
    assert rows(quality.row_count_metric(df, ["id"], "dup")) == [("dup", 2), ("total_rows", 5)]
    assert rows(quality.duplicate_keys(df, ["id"])) == [(2,)]
    assert rows(quality.missing_profile(df, {"name": "n", "id": "i"})) == [(5, 2, 2)]
    assert by_text(quality.check_unique(df, ["id"])) == [(1, 2), (None, 2)]
    assert rows(quality.check_not_null(df, ["id", "amount"])) == [("id", 2)]
    broken = quality.check_domain(df, {"name": 2}, {"amount": 999.99})
    assert rows(broken) == [("abs(amount) <= 999.99", 1), ("length(name) <= 2", 1)]
    known = values("key int", "(1)")
    assert rows(quality.check_foreign_key(df, "id", known, "key")) == [(2, 1)]
    assert rows(quality.unmatched_values(df, "name", values("n string", "('x')"), "n", "u")) == [
        ("long",),
        ("y",),
    ]
    assert [tuple(r) for r in quality.value_anomalies(df, F.col("amount")).collect()] == [
        (-1200, 5, Decimal("-237.60"), 2)
    ]


def test_empty_table_metrics(values):
    empty = values("id int, amount int", "(1, 1)").where("id > 1")
    assert rows(quality.row_count_metric(empty, ["id"])) == [
        ("duplicate_keys", 0),
        ("total_rows", 0),
    ]
    assert rows(quality.value_anomalies(empty, F.col("amount"))) == [(None, None, None, 0)]


def test_enforce(values):
    df = values("id int", "(1), (1)")
    quality.enforce({"fine": quality.check_not_null(df, ["id"])})
    with pytest.raises(quality.QualityError, match="twice"):
        quality.enforce({"twice": quality.check_unique(df, ["id"])})


def test_nested_average_weighs_groups_equally(values):
    df = values("o int, c string, s int", "(1, 'a', 1), (1, 'a', 1), (1, 'a', 1), (2, 'a', 5)")
    assert [(r.c, float(r.m)) for r in aggregates.nested_average(
        df, "o", "c", F.col("s"), "m").collect()] == [("a", 3.0)]


MONTHS = "(DATE'2016-10-01', 10), (DATE'2016-12-01', 20), (DATE'2017-01-01', 40)"


def test_series_count_rows_not_months(values):
    df = values("m date, v int", MONTHS)
    changed = series.point_change(df, "m", ["v"]).orderBy("m").collect()
    assert [r.v_change for r in changed] == [None, 10, 20]
    rolled = series.rolling_sums(df, "m", ["v"], rows=2).orderBy("m").collect()
    assert [(r.ltm_v, r.prior_ltm_v) for r in rolled] == [(10, None), (30, 10), (60, 30)]


def test_active_period(values):
    df = values("m date, v int", MONTHS)
    assert [r.v for r in series.active_period(df, "m", "2017-01-01").collect()] == [40]
    assert [r.v for r in series.active_period(df, "m", "2018-08-01").collect()] == [20]
    one = df.where("v = 10")
    assert series.active_period(one, "m", "2018-08-01").collect() == []


def test_share_of_total_and_zero_total(values):
    df = values("k int, v int", "(1, 1), (2, 2)")
    assert [float(r.s) for r in series.share_of_total(df, "v", "s").orderBy("k").collect()] == [
        33.33,
        66.67,
    ]
    zero = values("k int, v int", "(1, 0), (2, 0)")
    assert {r.s for r in series.share_of_total(zero, "v", "s").collect()} == {None}


def test_top_rows_breaks_ties(spark):
    data = list(range(50))
    random.Random(3).shuffle(data)
    df = spark.createDataFrame([(i, i // 10) for i in data], "id int, v int")
    assert [r.id for r in series.top_rows(df, 5, "v", ["id"]).collect()] == [40, 41, 42, 43, 44]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from tradewind.sources.tables import bucketed_table

    facts = [
        bucketed_table(
            spark.range(500).selectExpr("id AS order_id", f"id * {n} AS v{n}"),
            f"fact_{n}",
            str(tmp_path / f"fact_{n}"),
            4,
            ["order_id"],
        )
        for n in (1, 2)
    ]
    try:
        joined = facts[0].hint("merge").join(facts[1], "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.where("v2 = 2 * v1").count() == 500
    finally:
        for n in (1, 2):
            spark.sql(f"DROP TABLE fact_{n}")
