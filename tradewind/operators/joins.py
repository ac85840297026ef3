"""Joins that hold up under fan-out and hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may hold in a join or a ranking.
HOT_KEY_ROWS = 2_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Key values with more than ``hot_rows`` rows, and their counts.

    At most ``rows / hot_rows`` keys qualify, whatever the data looks like,
    which makes the result safe to broadcast: a trillion rows have at most
    500,000 keys above the default threshold.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > hot_rows)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_KEY_ROWS,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Equi join whose left side may hold one key in very many rows.

    Heavy keys are cut into ``count / hot_rows`` salts by the hash of
    ``spread`` (columns that differ between rows of one key), and the matching
    right rows are repeated once per salt. The repeats add up to at most
    ``left rows / hot_rows`` plus one per heavy key. Other keys join as usual.
    Rows with a NULL key match nothing: an inner join drops them, a left join
    spreads them by a hash of the row.

    The keys are counted in a pass of their own, over the key column alone, so
    this is for callers who expect such keys; adaptive execution splits the rest.
    If ``left`` is costly to compute, name a stored table in ``counts_from`` that
    has the key at least as often; salts only balance the work, so the result
    does not depend on the counts.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join supports inner and left joins, not {how}")
    salts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    keyed = left.where(F.col(key).isNotNull()) if how == "inner" else left
    counted = left if counts_from is None else counts_from
    heavy = heavy_keys(counted.where(F.col(key).isNotNull()), [key], hot_rows).select(
        key, salts.alias("_salts")
    )
    hashed = F.xxhash64(*[F.col(c) for c in spread])
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts"))).otherwise(_null_spread(left, key))
    salted_left = _left_join_spread(keyed, heavy, key).withColumn("_salt", salt)
    salted_right = right.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))
    )
    joined = salted_left.drop("_salts").join(salted_right.drop("_salts"), [key, "_salt"], how)
    return joined.drop("_salt")


def _null_spread(left: DataFrame, key: str) -> Column:
    """0 for rows with a key, else a hash of the row: rows without a key match nothing, and as
    part of a join key this sends them to different tasks."""
    hashable = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.when(F.col(key).isNull(), F.xxhash64(*hashable)).otherwise(F.lit(0).cast("long"))


def _left_join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A left join that reads its left side once, however many of its rows have no key."""
    spread = left.withColumn("_spread", _null_spread(left, key))
    met = right.withColumn("_spread", F.lit(0).cast("long"))
    return spread.join(met, [key, "_spread"], "left").drop("_spread")


def join_aggregated(
    left: DataFrame,
    right: DataFrame,
    key: str,
    aggregates: Sequence[Column],
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Left join to ``right`` aggregated to one row per key.

    Aggregating first keeps the left side's row count: three items of an order
    must not turn it into three rows.
    """
    joined = left.join(right.groupBy(key).agg(*aggregates), key, "left")
    for column, default in (defaults or {}).items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))
    return joined


def spine_join(spine: DataFrame, key: str, sides: Sequence[DataFrame]) -> DataFrame:
    """Left join several aggregates onto a frame that lists every key once."""
    for side in sides:
        spine = spine.join(side, key, "left")
    return spine


def lookup_with_default(
    left: DataFrame, dimension: DataFrame, key: str, column: str, default: Any
) -> DataFrame:
    """Left join one dimension column, replacing misses by ``default``.

    Whether the dimension is broadcast is left to Spark, which measures it, and
    a key that many rows share to its skew join. Rows without a key would all
    meet in one task, so they are spread by a second join key.
    """
    joined = _left_join_spread(left, dimension.select(key, column), key)
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    The right keys are made distinct first: one that fills much of the table
    reaches the join once per task.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def scalar_of(df: DataFrame, aggregate: Column) -> Column:
    """A global aggregate of ``df`` as a scalar subquery."""
    return df.agg(aggregate.alias("_scalar")).scalar()
