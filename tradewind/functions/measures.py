"""Ratios, growth and delivery flags.

Quotients are exact: both operands become decimals, one integer division gives the
quotient in units of its last place, rounded half up (away from zero). Integers,
decimals and doubles may be mixed; a double counts as the decimal that it prints as.
Percentages keep 15 decimals of operands below 10**16, and six of greater ones, up to
10**25; plain ratios keep two more.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.DecimalType(18, 2)

_MOST_DIGITS = 38
_FINE_BELOW = 16  # digits before the point
_WIDE_PLACES = 6


def _divided(numerator: Column, denominator: Column, digits: int, type_: str) -> Column:
    """``|numerator / denominator| * 10**digits`` as an integer, rounded half up."""
    top = F.abs(numerator.try_cast(type_))
    bottom = F.nullif(F.abs(denominator.try_cast(type_)), F.lit(0).cast(type_))
    doubled = top * F.lit(Decimal(2 * 10**digits)) + bottom
    return F.call_function("div", doubled, bottom * F.lit(Decimal(2)))


def exact_quotient(numerator: Column, denominator: Column, places: int = 2, shift: int = 0) -> Column:
    """``numerator * 10**shift / denominator`` as a decimal, rounded half up; NULL when the denominator is zero."""
    digits = places + shift
    # What is left of a decimal's digits for an operand: the product with 2 * 10**digits
    # has two more than its factors, and the sum may carry.
    kept = _MOST_DIGITS - digits - 3
    wide = F.greatest(F.abs(numerator.cast("double")), F.abs(denominator.cast("double"))) >= 10.0**_FINE_BELOW
    units = F.when(wide, _divided(numerator, denominator, digits, f"decimal({kept},{_WIDE_PLACES})")).otherwise(
        _divided(numerator, denominator, digits, f"decimal({kept},{kept - _FINE_BELOW})")
    )
    # An integer division that does not fit 64 bits would wrap around.
    about = F.abs(F.try_divide(numerator.cast("double"), denominator.cast("double"))) * 10.0**digits
    units = F.when(about >= 2.0**63, F.raise_error(F.lit("a quotient has more than 18 digits"))).otherwise(units)
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    return (units * sign).cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-places))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with two decimals; NULL when the denominator is zero."""
    return exact_quotient(numerator, denominator).cast(RESULT)


def safe_ratio_pct(numerator: Column, denominator: Column) -> Column:
    """Percentage with two decimals; NULL when the denominator is zero."""
    return exact_quotient(numerator, denominator, shift=2).cast(RESULT)


def change_pct(current: Column, previous: Column) -> Column:
    """Growth of ``current`` over ``previous`` in percent."""
    return safe_ratio_pct(current - previous, previous)


def late_flag(delivered: Column, estimated: Column) -> Column:
    """1 when delivery came after the estimate; an undelivered order is not late."""
    return F.when(delivered > estimated, 1).otherwise(0)


def fault_flags(is_late: Column, handover: Column, limit: Column) -> tuple[Column, Column]:
    """(seller at fault, carrier at fault) for late deliveries.

    The seller is at fault when the parcel reached the carrier after the
    shipping limit; the carrier when it got the parcel in time, or when no
    handover was recorded.
    """
    late = is_late == 1
    seller = F.when(late & (handover > limit), 1).otherwise(0)
    carrier = F.when(late & (handover.isNull() | (handover <= limit)), 1).otherwise(0)
    return seller, carrier


def primary_driver(
    carrier_share: Column,
    threshold: float = 60,
    carrier: str = "Carrier Delays",
    seller: str = "Slow Sellers",
) -> Column:
    """Who drives a route's delays; a route without late parcels counts as seller."""
    return F.when(carrier_share > threshold, carrier).otherwise(seller)


def delta_direction(value: Column, lower_is_better: bool = False) -> Column:
    """'up' for a change in the good direction, 'down' otherwise, NULL if unknown.

    Zero counts as a rise, so it reads 'down' where lower is better.
    """
    good, bad = ("down", "up") if lower_is_better else ("up", "down")
    return F.when(value >= 0, good).when(value < 0, bad)
