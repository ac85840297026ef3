"""Scalar expressions on hand-written values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import functions as fn


def column(df, expression):
    """The expression's value per ``k``."""
    rows = df.select("k", expression.alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.k)]


def test_title_case_splits_on_every_other_character(values):
    df = values(
        "k int, s string",
        "(1, 'santa barbara d''oeste'), (2, 'embu-guacu'), (3, 'SÃO JOÃO 2nd'), "
        "(4, ''), (5, NULL), (6, 'x'), (7, 'ßig straße')",
    )
    assert column(df, fn.title_case(F.col("s"))) == [
        "Santa Barbara D'Oeste",
        "Embu-Guacu",
        "São João 2nd",
        "",
        None,
        "X",
        "ßig Straße",
    ]


def test_blank_and_missing(values):
    df = values("k int, s string", "(1, ''), (2, NULL), (3, ' '), (4, 'a')")
    assert column(df, fn.blank_to_null(F.col("s"))) == [None, None, " ", "a"]
    assert column(df, fn.is_missing(df, "s")) == [True, True, False, False]


def test_safe_cast(values, spark):
    df = values("k int, s string", "(1, ''), (2, NULL), (3, '12')")
    assert column(df, fn.safe_cast(F.col("s"), T.IntegerType())) == [None, None, 12]
    junk = values("k int, s string", "(1, '12.5'), (2, 'abc'), (3, '7')")
    assert column(junk, fn.safe_cast(F.col("s"), T.IntegerType(), lenient=True)) == [
        None,
        None,
        7,
    ]
    with pytest.raises(PySparkException):
        column(junk, fn.safe_cast(F.col("s"), T.IntegerType()))
    stamps = values("k int, s string", "(1, '2017-10-02 10:56:33'), (2, '')")
    assert column(stamps, fn.safe_cast(F.col("s"), T.TimestampNTZType())) == [
        datetime(2017, 10, 2, 10, 56, 33),
        None,
    ]


def test_typed_leaves_typed_columns_alone(values):
    df = values("k int, s string", "(1, '1.5')").withColumn("d", F.lit(Decimal("2.25")))
    money = T.DecimalType(18, 4)
    assert column(df, fn.typed(df, "s", money)) == [Decimal("1.5000")]
    assert df.select(fn.typed(df, "d", money)).schema[0].dataType == T.DecimalType(3, 2)


def test_calendar(values):
    df = values(
        "k int, a timestamp_ntz, b timestamp_ntz",
        "(1, '2018-01-31 23:00:00', '2018-02-01 01:00:00'),"
        "(2, '2017-12-30 12:00:00', '2018-01-02 02:00:00'),"
        "(3, '2018-01-02 02:00:00', '2017-12-30 12:00:00'),"
        "(4, '2018-01-07 00:00:00', NULL)",
    )
    a, b = F.col("a"), F.col("b")
    assert column(df, fn.month_bucket(a)) == [
        date(2018, 1, 1),
        date(2017, 12, 1),
        date(2018, 1, 1),
        date(2018, 1, 1),
    ]
    assert column(df, fn.days_between(a, b)) == [
        Decimal("0.08"),
        Decimal("2.58"),
        Decimal("-2.58"),
        None,
    ]
    assert column(df, fn.whole_days(a, b)) == [0, 2, -2, None]
    assert column(df, fn.months_elapsed(a, b)) == [1, 1, -1, None]
    assert column(df, fn.day_name(fn.day_of_week(a))) == [
        "Wednesday",
        "Saturday",
        "Tuesday",
        "Sunday",
    ]
    assert column(df, fn.hour_of_day(a)) == [23, 12, 2, 0]


def test_days_between_rounds_half_away_from_zero(values):
    # 432 seconds are exactly 0.005 days.
    df = values(
        "k int, a timestamp_ntz, b timestamp_ntz",
        "(1, '2018-01-01 00:00:00', '2018-01-01 00:07:12'),"
        "(2, '2018-01-01 00:07:12', '2018-01-01 00:00:00'),"
        "(3, '2018-01-01 00:00:00', '2018-01-01 00:07:11.999999')",
    )
    assert column(df, fn.days_between(F.col("a"), F.col("b"))) == [
        Decimal("0.01"),
        Decimal("-0.01"),
        Decimal("0.00"),
    ]


def test_quotients_are_exact(spark, values):
    pairs = [
        ("1.00499999996", 1), ("1.005", 1), ("-1.005", 1), ("90071992547409931", 100), (1, 3), (5, 0), (None, 2), (2, None),
    ]
    rows = [(k, *(None if x is None else Decimal(x) for x in pair)) for k, pair in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k int, a decimal(32,11), b decimal(20,0)")
    assert column(df, fn.ratio(F.col("a"), F.col("b"))) == [
        Decimal(x) if x else None
        for x in ("1.00", "1.01", "-1.01", "900719925474099.31", "0.33", None, None, None)
    ]
    assert column(df, fn.safe_ratio_pct(F.col("b"), F.col("a")))[3:5] == [Decimal("0.00"), Decimal("300.00")]
    doubles = values("k int, a double, b double", "(1, 1.00499999996, 1), (2, 0.285, 1), (3, 0.06, 0.16), (4, 0.1, 3)")
    assert column(doubles, fn.ratio(F.col("a"), F.col("b"))) == [
        Decimal(x) for x in ("1.00", "0.29", "0.38", "0.03")
    ]


def test_quotients_that_do_not_fit_stop(spark):
    df = spark.createDataFrame([(Decimal(9 * 10**19), Decimal("0.5"))], "a decimal(38,6), b decimal(10,6)")
    with pytest.raises(Exception, match="more than 18 digits"):
        df.select(fn.ratio(F.col("a"), F.col("b"))).collect()


def test_ratios(values):
    df = values("k int, a bigint, b bigint", "(1, 1, 3), (2, 1, 0), (3, -1, 8), (4, NULL, 2)")
    assert column(df, fn.safe_ratio_pct(F.col("a"), F.col("b"))) == [
        Decimal("33.33"),
        None,
        Decimal("-12.50"),
        None,
    ]
    tie = values("k int, a bigint, b bigint", "(1, 1, 1600), (2, -1, 1600), (3, 12345, 100000)")
    assert column(tie, fn.safe_ratio_pct(F.col("a"), F.col("b"))) == [
        Decimal("0.06"),
        Decimal("-0.06"),
        Decimal("12.35"),
    ]
    assert column(tie, fn.change_pct(F.col("a"), F.col("b")))[0] == Decimal("-99.94")


def test_late_and_fault_flags(values):
    df = values(
        "k int, late int, handover timestamp_ntz, lim timestamp_ntz",
        "(1, 1, '2018-01-02', '2018-01-01'),"
        "(2, 1, '2018-01-01', '2018-01-01'),"
        "(3, 1, NULL, '2018-01-01'),"
        "(4, 0, '2018-01-02', '2018-01-01')",
    )
    seller, carrier = fn.fault_flags(F.col("late"), F.col("handover"), F.col("lim"))
    assert column(df, seller) == [1, 0, 0, 0]
    assert column(df, carrier) == [0, 1, 1, 0]
    assert column(df, fn.late_flag(F.col("handover"), F.col("lim"))) == [1, 0, 0, 1]


def test_driver_and_direction(values):
    df = values("k int, v double", "(1, 60.0), (2, 60.01), (3, NULL), (4, -1.0), (5, 0.0)")
    assert column(df, fn.primary_driver(F.col("v"))) == [
        "Slow Sellers",
        "Carrier Delays",
        "Slow Sellers",
        "Slow Sellers",
        "Slow Sellers",
    ]
    assert column(df, fn.delta_direction(F.col("v"))) == ["up", "up", None, "down", "up"]
    assert column(df, fn.delta_direction(F.col("v"), lower_is_better=True)) == [
        "down",
        "down",
        None,
        "up",
        "down",
    ]


def test_labels(values):
    df = values("k int, a string, b string", "(1, 'bed_bath_table', 'SP')")
    assert column(df, fn.display_label(F.col("a"))) == ["bed bath table"]
    assert column(df, fn.route_label(F.col("b"), F.lit("AL"))) == ["SP ➔ AL"]
