"""Date and time expressions. Timestamps carry no zone."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROSECONDS_PER_DAY = 86_400_000_000

# Weekday names, Sunday first.
DAY_NAMES = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)


def month_bucket(ts: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(ts, "month")


def days_between(start: Column, end: Column, precision: int = 9, scale: int = 2) -> Column:
    """Fractional days from ``start`` to ``end``, rounded half away from zero.

    Rounds in whole microseconds, so the result is exact; ``scale`` may go up
    to 8, the finest step that is a whole number of them.
    """
    step = MICROSECONDS_PER_DAY // 10**scale
    micros = F.timestamp_diff("MICROSECOND", start, end)
    steps = F.call_function("div", F.abs(micros) + F.lit(step // 2), F.lit(step))
    unit = F.lit(Decimal(1).scaleb(-scale))
    signed = F.when(micros < 0, -steps).otherwise(steps).cast(T.DecimalType(18, 0))
    return (signed * unit).cast(T.DecimalType(precision, scale))


def whole_days(start: Column, end: Column) -> Column:
    """Complete days in the interval, dropping the remaining hours."""
    return F.extract(F.lit("DAY"), end - start)


def months_elapsed(start: Column, end: Column) -> Column:
    """Calendar months from ``start`` to ``end``; the day of month is ignored."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def day_of_week(ts: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(ts) - 1


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), dow + 1)
