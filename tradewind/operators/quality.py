"""Profiling and data-quality checks.

Every check is one aggregation with map-side partials, so a key that holds
much of the table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import is_missing, ratio


def _as_rows(df: DataFrame, label: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """Turn a one-row frame into (label, value) rows."""
    pairs = [
        F.struct(F.lit(name).alias(label), F.col(column).alias(value))
        for name, column in columns.items()
    ]
    return df.select(F.inline(F.array(*pairs)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_keys") -> DataFrame:
    """How many key values occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .agg(F.count_if(F.col("n_rows") > 1).alias(name))
    )


def row_count_metric(
    df: DataFrame, keys: Sequence[str], duplicate_label: str = "duplicate_keys"
) -> DataFrame:
    """(metric, val): total rows and duplicated keys, from one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = per_key.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"),
        F.count_if(F.col("n_rows") > 1).alias("repeated"),
    )
    return _as_rows(
        totals, "metric", "val", {"total_rows": "total", duplicate_label: "repeated"}
    )


def missing_profile(
    df: DataFrame, columns: Mapping[str, str], total: str = "total_records"
) -> DataFrame:
    """One row: record count and NULL-or-blank count per column.

    ``columns`` maps a column to the name of its count.
    """
    counts = [F.count_if(is_missing(df, c)).alias(label) for c, label in columns.items()]
    return df.agg(F.count(F.lit(1)).alias(total), *counts)


def category_distribution(
    df: DataFrame,
    key: str,
    value: Column,
    count_name: str = "transaction_count",
    sum_name: str = "total_payment_value",
) -> DataFrame:
    """Rows and rounded sum per key value, most frequent first."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias(count_name),
            F.round(F.sum(value), 2).alias(sum_name),
        )
        .orderBy(F.desc(count_name), F.asc_nulls_last(key))
    )


def value_anomalies(df: DataFrame, value: Column, label: str = "payment") -> DataFrame:
    """Minimum, maximum, rounded mean and number of values at or below zero."""
    return (
        df.select(value.alias("v"))
        .agg(
            F.min("v").alias(f"min_{label}"),
            F.max("v").alias(f"max_{label}"),
            F.sum("v").alias("s"),
            F.count("v").alias("n"),
            F.count_if(F.col("v") <= 0).alias("zero_or_negative_count"),
        )
        .select(
            f"min_{label}",
            f"max_{label}",
            ratio(F.col("s"), F.col("n")).alias(f"avg_{label}"),
            "zero_or_negative_count",
        )
    )


def unmatched_values(
    df: DataFrame, column: str, dimension: DataFrame, dimension_column: str, name: str
) -> DataFrame:
    """Distinct present values of ``column`` that the dimension does not know.

    Values are made distinct before the anti join, so the join sees each once.
    """
    values = df.where(~is_missing(df, column)).select(F.col(column).alias(name)).distinct()
    known = dimension.select(F.col(dimension_column).alias(name))
    return values.join(known, name, "left_anti")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations) for each required column that holds NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _as_rows(counts, "column_name", "violations", {c: c for c in columns}).where(
        F.col("violations") > 0
    )


def check_foreign_key(
    fact: DataFrame, column: str, dimension: DataFrame, dimension_column: str
) -> DataFrame:
    """Key values without a dimension row, with the number of orphan rows.

    Orphans are counted per key before the anti join.
    """
    keys = fact.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = dimension.select(F.col(dimension_column).alias(column))
    return keys.join(known, column, "left_anti")


def check_domain(
    df: DataFrame,
    max_length: Mapping[str, int] | None = None,
    max_abs: Mapping[str, float] | None = None,
) -> DataFrame:
    """(rule, violations) for text longer, or numbers larger, than declared."""
    rules = {
        f"length({c}) <= {n}": F.length(F.col(c)) > n for c, n in (max_length or {}).items()
    }
    rules |= {f"abs({c}) <= {n}": F.abs(F.col(c)) > n for c, n in (max_abs or {}).items()}
    names = {rule: f"rule_{i}" for i, rule in enumerate(rules)}
    counts = df.agg(*[F.count_if(test).alias(names[rule]) for rule, test in rules.items()])
    return _as_rows(counts, "rule", "violations", names).where(F.col("violations") > 0)


def validate_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


class QualityError(ValueError):
    """Raised when a table breaks its declared constraints."""


def enforce(checks: Mapping[str, DataFrame]) -> None:
    """Fail when any check returns rows. One job counts all of them."""
    counts = validate_row_counts(checks).where(F.col("row_count") > 0)
    # At most one row per check.
    broken = {row.table_name: row.row_count for row in counts.collect()}
    if broken:
        raise QualityError(f"constraint violations: {broken}")
