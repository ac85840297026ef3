"""Cleaning and casting of text columns."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(col: Column) -> Column:
    """Empty text becomes NULL; anything else is unchanged."""
    return F.nullif(col, F.lit(""))


def safe_cast(col: Column, data_type: T.DataType | str, lenient: bool = False) -> Column:
    """Cast text, reading blanks as NULL.

    Other text that does not parse raises under ANSI mode (Spark's default);
    ``lenient`` turns it into NULL instead.
    """
    present = blank_to_null(col)
    return present.try_cast(data_type) if lenient else present.cast(data_type)


def typed(df: DataFrame, name: str, data_type: T.DataType, lenient: bool = False) -> Column:
    """Column ``name`` as ``data_type``.

    Text sources get the blank-safe cast; columns that already carry a type
    (Parquet, tables) are not sent through text. A decimal keeps its own
    precision: Spark sums up to eight digits on plain longs.
    """
    actual = df.schema[name].dataType
    if isinstance(actual, T.StringType):
        if isinstance(data_type, T.StringType):
            return F.col(name)
        return safe_cast(F.col(name), data_type, lenient)
    both_decimal = isinstance(actual, T.DecimalType) and isinstance(data_type, T.DecimalType)
    if actual == data_type or both_decimal:
        return F.col(name)
    return F.col(name).try_cast(data_type) if lenient else F.col(name).cast(data_type)


def is_missing(df: DataFrame, name: str) -> Column:
    """True where the column is NULL or, for text, blank."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, T.StringType):
        missing = missing | (F.col(name) == "")
    return missing


def default_value(col: Column, default: Any) -> Column:
    return F.coalesce(col, default if isinstance(default, Column) else F.lit(default))


def title_case(col: Column) -> Column:
    """Capitalise the first character after every non-alphanumeric one.

    ``initcap`` only splits on spaces; this keeps "D'Oeste" and "Embu-Guacu".
    A letter without a single-letter capital (ß) stays as it is.
    """
    words = F.split(F.lower(col), r"(?<=[^\p{L}\p{N}])")

    def capitalised(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        upper = F.upper(first)
        return F.concat(
            F.when(F.length(upper) == 1, upper).otherwise(first), F.substr(word, F.lit(2))
        )

    return F.array_join(F.transform(words, capitalised), "")


def upper_code(col: Column) -> Column:
    return F.upper(col)


def display_label(col: Column) -> Column:
    """Underscores shown as spaces."""
    return F.replace(col, F.lit("_"), F.lit(" "))


def route_label(origin: Column, destination: Column, separator: str = " ➔ ") -> Column:
    return F.concat_ws(separator, origin, destination)
