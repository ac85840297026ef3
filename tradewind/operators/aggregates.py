"""Aggregations made of several stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.measures import exact_quotient

# Decimals of a group's mean; sums of such means are exact.
_MEAN_PLACES = 12


def nested_average(
    df: DataFrame, inner: str, outer: str, value: Column, name: str, places: int = 2
) -> DataFrame:
    """Mean per ``outer`` of the means per ``inner``.

    Every inner group weighs the same, however many rows it has. Each inner
    group must belong to one ``outer`` value. Means keep twelve decimals.
    """
    mean = exact_quotient(F.sum(value), F.count(value), _MEAN_PLACES)
    means = df.groupBy(outer, inner).agg(mean.alias("_mean"))
    average = exact_quotient(F.sum("_mean"), F.count("_mean"), places)
    return means.groupBy(outer).agg(average.cast(T.DecimalType(18, places)).alias(name))
