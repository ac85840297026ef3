"""CSV records from byte ranges of a file, quoted line breaks included.

Spark splits text files at line breaks, and whether a line break ends a record depends on
all quotes before it. So the quotes of every byte range are counted first; the parities of
the ranges before it tell whether a range begins inside a quoted field. With that, each
range finds its own records, whatever its place in the file. A record that goes on in the
next range is put together from the parts that the ranges leave over, two for each at most.

Files have to follow RFC 4180: quotes stand around a field or doubled inside a quoted one. A
stray quote shifts the records behind it, whose number of fields then stops the load.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, range, value`` of every physical line, in the order of its range."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value"
    )


def is_line_per_record(spark: SparkSession, path: str) -> bool:
    """Whether every line of the files at a path is a whole record or empty, so that Spark may split them
    at line breaks: no quoted line break, no carriage return, no line of blanks only (Spark's reader
    drops those). The search ends with the first other line."""
    value = F.col("value")
    blank = (value != "") & ~value.rlike(r"[^\x00-\x20]")
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where((_quotes(value) % 2 == 1) | value.contains("\r") | blank).isEmpty()


def _quotes(value: Column) -> Column:
    return F.char_length(value) - F.char_length(F.replace(value, F.lit('"'), F.lit("")))


def _open_ranges(lines: DataFrame) -> DataFrame:
    """``file, range, inside``: whether a range begins in a quoted field. One row a range."""
    odd = lines.groupBy("file", "range").agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "range", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Range:
    """Records of the range at hand, line by line."""

    def __init__(self, key: tuple[int, int], inside: bool):
        self.key, self.inside = key, inside
        self.kind = _HEAD if inside else _WHOLE
        self.first = key[1] == 0  # the file's first record is to come
        self.open: list[str] = []

    def records(self, lines: pa.Array) -> tuple[list[int], list[bool], list[str]]:
        """Kinds and texts of what ends in these lines, and which is a file's first."""
        odd = np.asarray(pc.count_substring(lines, '"')) & 1
        after = (np.cumsum(odd) + self.inside) & 1
        texts = lines.to_pylist()
        kinds, firsts, found = [], [], []
        for text, goes_on in zip(texts, after.tolist()):
            self.open.append(text)
            if not goes_on:
                kinds.append(self.kind)
                firsts.append(self.first)
                found.append("\n".join(self.open) if len(self.open) > 1 else text)
                self.open, self.kind, self.first = [], _WHOLE, False
        self.inside = bool(after[-1]) if len(after) else self.inside
        return kinds, firsts, found

    def rest(self) -> tuple[list[int], list[bool], list[str]]:
        """The part that the next range goes on with; a range without any end is a head."""
        if not self.open:
            return [], [], []
        return [_TAIL if self.kind == _WHOLE else _HEAD], [self.first], ["\n".join(self.open)]


def _parts(lines: DataFrame) -> DataFrame:
    """``file, range, kind, first, record``: whole records, and parts of those that cross ranges.

    The order of lines has to stay, so the table of ranges, one row for each 100 MB or
    so of text, is broadcast.
    """
    known = lines.join(F.broadcast(_open_ranges(lines)), ["file", "range"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Range | None = None

        def out(kinds: list[int], firsts: list[bool], found: list[str]) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([at.key[0]] * n, pa.int64()), pa.array([at.key[1]] * n, pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(firsts, pa.bool_()), pa.array(found, pa.string())],
                names=["file", "range", "kind", "first", "record"],
            )

        for batch in batches:
            file, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "range"))
            new = np.ones(batch.num_rows, bool)
            new[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
            begins = np.flatnonzero(new)
            for begin, end in zip(begins, np.append(begins[1:], batch.num_rows)):
                key = (int(file[begin]), int(start[begin]))
                if at is None or at.key != key:
                    if at is not None:
                        yield out(*at.rest())
                    at = _Range(key, batch.column("inside")[int(begin)].as_py())
                yield out(*at.records(batch.column("value").slice(int(begin), int(end - begin))))
        if at is not None:
            yield out(*at.rest())

    return known.mapInArrow(run, "file long, range long, kind int, first boolean, record string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``first, record``: all records of the files at a path; ``first`` marks those that a file
    begins with. Empty lines are left out."""
    parts = _parts(_lines(spark, path))
    # A tail begins a record, and the heads up to the next tail go on with it.
    order = Window.partitionBy("file").orderBy("range", "kind")
    tails = F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order)
    pieces = F.array_sort(F.collect_list(F.struct("range", "kind", "record")))
    joined = (
        parts.where(F.col("kind") != _WHOLE)
        .withColumn("number", tails)
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"))
    )
    every = parts.where(F.col("kind") == _WHOLE).select("first", "record").unionByName(joined.select("first", "record"))
    # A record that ends like a Windows line has such line breaks inside as well.
    text = F.col("record")
    plain = F.replace(F.left(text, F.char_length(text) - 1), F.lit("\r\n"), F.lit("\n"))
    return every.withColumn("record", F.when(text.endswith("\r"), plain).otherwise(text)).where("record <> ''")


def read_csv(spark: SparkSession, path: str, header: Sequence[str], options: Mapping[str, str]) -> DataFrame:
    """The files' rows as text columns ``c0, c1 …``. Each file has to begin with ``header``."""
    fields = [f"c{n}" for n in range(len(header))]
    schema = ", ".join(f"{f} string" for f in fields)
    row = F.from_csv(F.ltrim("record", F.lit("\ufeff")), schema, {**options, "multiLine": "true"})
    parsed = read_records(spark, path).select("first", row.alias("row"))
    names = F.struct(*[F.lit(h or None).cast("string").alias(f) for f, h in zip(fields, header)])
    other = F.raise_error(F.concat(F.lit("header does not conform: "), F.to_json("row")))
    is_header = F.when(F.col("first") & ~F.col("row").eqNullSafe(names), other).otherwise(F.col("first"))
    return parsed.where(~is_header).select("row.*")
