"""Windows over already aggregated rows.

Each windowed function here takes one row per period or per group: a few hundred
months, 168 hours of the week, a handful of segments. Only such frames may go
through a window without partition keys. Shares of a total have no such limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import safe_ratio_pct
from tradewind.operators.joins import scalar_of


def previous(column: str, order: str, rows: int = 1) -> Column:
    """Value of an earlier row. Counts rows, not months: gaps are skipped."""
    return F.lag(column, rows).over(Window.orderBy(order))


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Each row's percentage of the column total.

    The total is a scalar subquery: one row whatever the input's size, so this
    works on any frame, not only on aggregated ones.
    """
    # A column of its own, as the quotient mentions its operands several times.
    with_total = df.withColumn("_total", scalar_of(df, F.sum(value)))
    return with_total.withColumn(name, safe_ratio_pct(F.col(value), F.col("_total"))).drop("_total")


def share_of_rows(df: DataFrame, value: str, name: str) -> DataFrame:
    """The same for a handful of aggregated rows, which are not computed twice for it."""
    with_total = df.withColumn("_total", F.sum(value).over(Window.partitionBy()))
    return with_total.withColumn(name, safe_ratio_pct(F.col(value), F.col("_total"))).drop("_total")


def rolling_sums(
    df: DataFrame, order: str, columns: Sequence[str], rows: int = 12, prefix: str = "ltm"
) -> DataFrame:
    """Sums over the last ``rows`` rows, and over the ``rows`` before the current one.

    Early rows sum what there is; the first has no prior sum.
    """
    current = Window.orderBy(order).rowsBetween(1 - rows, 0)
    prior = Window.orderBy(order).rowsBetween(-rows, -1)
    return df.select(
        "*",
        *[F.sum(c).over(current).alias(f"{prefix}_{c}") for c in columns],
        *[F.sum(c).over(prior).alias(f"prior_{prefix}_{c}") for c in columns],
    )


def point_change(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_change``: the difference to the previous row."""
    return df.select(
        "*", *[(F.col(c) - previous(c, order)).alias(f"{c}_change") for c in columns]
    )


def active_period(df: DataFrame, order: str, target: date | str) -> DataFrame:
    """The row of the named period or, when it is absent, the last but one."""
    latest_first = Window.orderBy(F.desc(order))
    everything = Window.partitionBy()
    is_target = F.col(order) == F.lit(target).cast("date")
    marked = df.select(
        "*",
        is_target.alias("_is_target"),
        F.max(is_target).over(everything).alias("_found"),
        F.row_number().over(latest_first).alias("_from_end"),
    )
    wanted = F.col("_is_target") | (~F.col("_found") & (F.col("_from_end") == 2))
    return marked.where(wanted).select(*df.columns)


def period_range(
    df: DataFrame, column: str, first: date | str, last: date | str
) -> DataFrame:
    """Rows between two periods, both included."""
    return df.where(
        F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )


def top_rows(
    df: DataFrame, n: int, by: str, ties: Sequence[str], ascending: bool = False
) -> DataFrame:
    """The ``n`` best rows, ties broken by further columns."""
    lead = F.asc_nulls_last(by) if ascending else F.desc_nulls_first(by)
    return df.orderBy(lead, *[F.asc_nulls_last(c) for c in ties]).limit(n)
