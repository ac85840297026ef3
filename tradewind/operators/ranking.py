"""Ranks and tiles without gathering rows in one task, and without a job before the query runs.

A total order is cut into slices at marks: keys of a sample of rows, picked by a hash of
the key, so that every evaluation finds the same ones. Counts per slice say how many rows
lie before it, and a window within a slice does the rest. All of it is one lazy plan: the
marks are a scalar subquery, and nothing is written to storage.

End an order with a unique column: a value that most rows share is then cut like any
other, by the columns behind it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.joins import HOT_KEY_ROWS, scalar_of

# Marks of one order, about: they reach every task as one array.
MARKS = 1024
_STEPS = [1 << k for k in reversed(range(12))]  # finds up to four times as many
_FEW_TILES = 16  # compared one by one, in generated code


class _Order:
    """Sort columns as key columns with their directions, and one struct that sorts like them.

    The struct rises: a falling number is negated, nulls that come last get a flag. A falling
    column of another type has no such form; its rank among the values of the sample
    would need a search of its own, so it is refused.
    """

    def __init__(self, df: DataFrame, order: Sequence[Column], prefix: str = "_k"):
        self.parts = [_direction(column) for column in order]
        self.names = [f"{prefix}{i}" for i in range(len(self.parts))]
        fields = []
        keyed = df.select(*[c.alias(n) for n, (c, _, _) in zip(self.names, self.parts)])
        for field, (_, falls, nulls_first) in zip(keyed.schema.fields, self.parts):
            column = F.col(field.name)
            if falls and isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
                column = F.unix_micros(column.cast("timestamp"))
            elif falls and isinstance(field.dataType, T.DateType):
                column = F.unix_date(column)
            elif falls and not isinstance(field.dataType, T.NumericType):
                raise ValueError(f"a falling order needs numbers or times, not {field.dataType.simpleString()}")
            if not nulls_first:
                fields.append(column.isNull())
            fields.append(-column if falls else column)
        self.key = F.struct(*[c.alias(f"f{i}") for i, c in enumerate(fields)])

    def keyed(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[c.alias(n) for n, (c, _, _) in zip(self.names, self.parts)])

    def sort(self) -> list[Column]:
        ways = {(False, True): F.asc_nulls_first, (False, False): F.asc_nulls_last}
        ways |= {(True, True): F.desc_nulls_first, (True, False): F.desc_nulls_last}
        return [ways[falls, first](n) for n, (_, falls, first) in zip(self.names, self.parts)]


def _direction(column: Column) -> tuple[Column, bool, bool]:
    """A sort column's expression, whether it falls, and whether nulls come first."""
    node = column._jc.node()
    if node.getClass().getSimpleName() != "SortOrder":
        return column, False, True
    expression = SparkSession.active()._jvm.org.apache.spark.sql.Column(node.child())
    falls = "Descending" in node.sortDirection().toString()
    return Column(expression), falls, "NullsFirst" in node.nullOrdering().toString()


def _sample(keyed: DataFrame, names: Sequence[str], step: Column) -> DataFrame:
    """About one row in ``step`` by the hash of its keys, always the same."""
    return keyed.where(F.pmod(F.xxhash64(*names), step) == 0).select(*names)


def _marks(sample: DataFrame, order: _Order) -> Column:
    """The keys in order, as a scalar subquery."""
    return _in_order(sample.select(order.key.alias("_key")))


def _in_order(keys: DataFrame) -> Column:
    return keys.agg(F.sort_array(F.collect_set("_key"))).scalar()


def _even_step(keyed: DataFrame, names: Sequence[str], marks: int) -> Column:
    """The step that gives about that many marks.

    Rows are counted by their hash: a count that reads the keys, as every other part
    does, finds the shuffles below it done by them.
    """
    rows = F.count_if(F.xxhash64(*names) != 0)
    return scalar_of(keyed, F.greatest(F.lit(1), F.ceil(rows / marks)))


def _sliced(keyed: DataFrame, order: _Order, marks: Column) -> DataFrame:
    """Add ``_slice``, the number of marks before the row, found by binary search.

    The marks are named once, so that the optimizer puts the subquery's value into the
    search itself and no row carries the array.
    """

    halve = lambda low, step: F.when(
        F.get(F.col("_marks"), low + step - 1) < order.key, low + step
    ).otherwise(low)
    slice_ = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), halve)
    return keyed.select("*", marks.alias("_marks")).select(*keyed.columns, slice_.alias("_slice"))


def _rows_before(counts: DataFrame) -> DataFrame:
    """``_slice, _n, _before``; one row a slice."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_slice", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def global_position(df: DataFrame, order: Sequence[Column], name: str, marks: int = MARKS) -> DataFrame:
    """Add each row's 1-based position in the total order ``order``."""
    by = _Order(df, order)
    keyed = by.keyed(df)
    sample = _sample(keyed, by.names, _even_step(keyed, by.names, marks))
    sliced = _sliced(keyed, by, _marks(sample, by))
    offsets = _rows_before(sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*by.sort()))
    placed = sliced.withColumn("_within", within).join(F.broadcast(offsets), "_slice")
    return placed.select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def _cut_keys(keys: DataFrame, sample: DataFrame, by: _Order, buckets: int) -> Column:
    """The keys of the last rows of all tiles but the last, in order, as a scalar subquery.

    The first ``total % buckets`` tiles hold one row more than the others. Rows are
    counted per slice; only slices that hold a cut are ranked.
    """
    # Counts and ranks read the same shuffle of the keys.
    sliced = _sliced(keys.select(*by.names), by, _marks(sample, by)).repartition("_slice")
    counts = _rows_before(sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")))
    total = F.sum("_n").over(Window.partitionBy())
    last = F.col("_tile") * F.expr(f"_total div {buckets}") + F.least("_tile", F.col("_total") % buckets)
    cuts = (
        counts.withColumn("_total", total)
        .withColumn("_tile", F.explode(F.sequence(F.lit(1), F.lit(buckets - 1))))
        .withColumn("_place", last - F.col("_before"))
        .where(F.col("_place").between(1, F.col("_n")))
        .groupBy("_slice")
        .agg(F.collect_set("_place").alias("_places"))
    )
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(*by.sort())).cast("long")
    ranked = sliced.join(F.broadcast(cuts), "_slice").withColumn("_within", within)
    return _in_order(ranked.where(F.array_contains("_places", F.col("_within"))).select(by.key.alias("_key")))


def distributed_ntiles(
    df: DataFrame, tiles: Mapping[str, tuple[int, Sequence[Column]]], marks: int = MARKS
) -> DataFrame:
    """``NTILE(buckets)`` over all rows, for several orders at once, without a window over the rows.

    ``tiles`` has the number of buckets and the order of each new column. Only keys are
    shuffled: a row's tile follows from how many of the ``buckets - 1`` cut keys lie before it. One task ranks about one row in ``marks`` for a cut; more of them suit tables of
    more than 10**10 rows. All orders share one sample.
    """
    orders = {name: _Order(df, order, f"_k{n}_") for n, (name, (_, order)) in enumerate(tiles.items())}
    keyed = df
    for by in orders.values():
        keyed = by.keyed(keyed)
    names = [name for by in orders.values() for name in by.names]
    keys = keyed.select(*names)
    sample = _sample(keys, names, _even_step(keys, names, marks))
    tiled = keyed
    for name, (buckets, _) in tiles.items():
        if not 1 <= buckets <= sum(_STEPS):
            raise ValueError(f"between 1 and {sum(_STEPS)} tiles, not {buckets}")
        if buckets == 1:
            tiled = tiled.withColumn(name, F.lit(1))
            continue
        by = orders[name]
        cuts = _cut_keys(keys, sample, by, buckets)
        if buckets <= _FEW_TILES:
            passed = [F.when(F.get("_cuts", F.lit(n)) < by.key, 1).otherwise(0) for n in range(buckets - 1)]
            tile = sum(passed, F.lit(1))
            tiled = tiled.select("*", cuts.alias("_cuts")).withColumn(name, tile).drop("_cuts")
        else:
            tiled = _sliced(tiled, by, cuts).withColumn(name, F.col("_slice") + 1).drop("_slice")
    return tiled.select(*df.columns, *tiles)


def distributed_ntile(
    df: DataFrame, buckets: int, order: Sequence[Column], name: str, marks: int = MARKS
) -> DataFrame:
    """``NTILE(buckets)`` over all rows in one order, as :func:`distributed_ntiles`."""
    return distributed_ntiles(df, {name: (buckets, order)}, marks)


def sequence_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``ROW_NUMBER`` per key for tables where one key may hold most rows.

    Rows are cut into slices by key and order, one mark in ``hot_rows`` rows at most. A key
    of ordinary size lies in one slice, or two; a heavy one fills many, which are
    ranked apart. What a key has in earlier slices is counted only for keys that a mark
    cuts: one for each end of a slice. ``order`` must end with a unique column.
    """
    by = _Order(df, [*[F.asc(k) for k in keys], *order])
    own = by.names[: len(keys)]
    keyed = by.keyed(df)
    step = F.greatest(F.lit(hot_rows), _even_step(keyed, by.names, MARKS))
    sample = _sample(keyed, by.names, step)
    sliced = _sliced(keyed, by, _marks(sample, by))

    def same(names: Sequence[str]) -> Column:
        result = F.lit(True)
        for mine, other in zip(own, names):
            result = result & F.col(mine).eqNullSafe(F.col(other))
        return result

    others = [f"_of{k}" for k in own]
    renamed = lambda df, *more: df.select(*[F.col(a).alias(b) for a, b in zip(own, others)], *more)
    # One key a mark at most, and one of its slices a mark: both are small whatever the data.
    cut = F.broadcast(renamed(sample).distinct())
    earlier = Window.partitionBy(*own).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.select("_slice", *own)
        .join(cut, same(others), "left_semi")
        .groupBy("_slice", *own)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .where("_before > 0")
    )
    window = Window.partitionBy("_slice", *own).orderBy(*by.sort()[len(keys) :])
    ranked = sliced.withColumn("_within", F.row_number().over(window).cast("long"))
    offsets = F.broadcast(renamed(before, F.col("_slice").alias("_in"), "_before"))
    placed = ranked.join(offsets, (F.col("_slice") == F.col("_in")) & same(others), "left")
    return placed.select(*df.columns, (F.col("_within") + F.coalesce("_before", F.lit(0))).alias(name))
