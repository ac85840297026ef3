"""Keeping one row per key, and guarded inserts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The row with the highest ``order_by`` per key; a NULL ranks highest.

    The maximum of a struct is combined map-side, so a key with many rows
    never gathers them in one task the way a ranking window would. Equal
    ``order_by`` values fall back to the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c != order_by]
    candidate = F.struct(F.col(order_by).isNull().alias("_absent"), order_by, *rest)
    best = df.groupBy(*keys).agg(F.max(candidate).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [order_by, *rest]])


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the smallest remaining columns, so re-runs agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def literal_rows(
    spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence[Any]]
) -> DataFrame:
    """A few constant rows as a DataFrame, made inside the plan."""

    def struct(row: Sequence[Any]) -> Column:
        return F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for value, field in zip(row, schema.fields)
            ]
        )

    return spark.range(1).select(F.inline(F.array(*[struct(row) for row in rows])))


def insert_if_absent(
    existing: DataFrame, rows: Sequence[Sequence[Any]], key: str
) -> DataFrame:
    """Append the constant rows whose key the table lacks.

    Of rows with the same key the first is added, as if they were inserted one
    by one. A NULL key equals no other and is always added. Otherwise, running it
    twice adds nothing. The keys go into the table's scan as a
    filter, so only the ones found are compared.
    """
    position = existing.columns.index(key)
    seen: set[Any] = set()
    first = [
        row
        for row in rows
        if row[position] is None or not (row[position] in seen or seen.add(row[position]))
    ]
    found = existing.where(F.col(key).isin([row[position] for row in first if row[position] is not None]))
    added = literal_rows(existing.sparkSession, existing.schema, first).join(
        found.select(key).distinct(), key, "left_anti"
    )
    return existing.unionByName(added)
