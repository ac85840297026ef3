"""Reading the test tables and small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def text_of(column: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of a column's decimal text modulo ``modulus``; a null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
