"""Line dedup over levelled, sorted runs of line hashes.

A line's key is the line without blanks at both ends, A-Z in lower case. Keys of
``least_chars`` code points found in ``least_docs`` documents lose all their
lines except those in the largest doc_id that holds the key.

Runs. The index is a set of runs: bucketed tables, each bucket sorted by key hash,
that hold a key with the number of its documents and the largest of their ids. A
batch of documents is counted per key, sorted into the same buckets and
merge-anti-joined with every run. Keys that no run has are new and make up the
batch's own run, so the runs are disjoint; counts of known keys go to a log of
repeats. ``fanout`` runs of a level are compacted into one run of the next, so a
key is rewritten once a level and a batch meets few runs. Buckets line up: neither
the anti-joins nor a compaction, a full merge join, shuffle anything. A tally merges
the log of repeats into the runs.

Built-in functions only. Texts are shuffled once, to meet the positions of their
dropped lines. A key held by a third of all documents is one row a batch in the
runs; its lines meet the tally in a join that adaptive execution can split, both
sides being plain tables.

Keys are compared by two 64-bit hashes; a false match takes a collision of both.

Defined results: a null text is empty, and an empty text is one empty line; a
document is its doc_id, so rows that share one count as one document and a null id
is one document, before all others; of a key's lines in the document that keeps
them all stay, repeats included; equal rows are treated alike; an empty table
gives no rows; other columns are kept, whatever their names. A very long text is
one row: its lines are read once, and the work is linear in them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.components import stored
from tradewind.llm.tables import ascii_lower
from tradewind.session import scratch_path

LEAST_CHARS = 20
LEAST_DOCS = 3
BATCHES = 4
FANOUT = 2
ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 20_000
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
_NO_ID = -(1 << 63)


class LineRuns:
    """An index of line keys as levelled runs in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []
        self._tables: list[str] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, counted: DataFrame) -> DataFrame:
        """Take a batch's ``h1, h2, docs, newest``, a row a key, and return the keys that no run had."""
        batch = self._sorted(counted.repartition(self.buckets, *KEY))
        if not self.runs:
            own = batch
        else:
            own = self._sorted(reduce(_not_in, self.runs, batch))
            self.repeats.append(stored(_not_in(batch, own), "repeats"))
        self._place(own, 0)
        return own

    def tally(self) -> DataFrame:
        """``h1, h2, docs, newest`` of every key over all batches."""
        runs = reduce(_merged, self.runs)
        if not self.repeats:
            return runs
        again = reduce(DataFrame.unionByName, self.repeats).groupBy(*KEY)
        return _merged(runs, again.agg(F.sum("docs").alias("docs"), F.max("newest").alias("newest")))

    def close(self) -> None:
        """Forget the runs' names; their files go with the scratch folders."""
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _place(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._sorted(reduce(_merged, self.levels[level]))
            self.levels[level] = []
            self._place(merged, level + 1)

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """The rows as a bucketed table, sorted by key within its buckets."""
        name = f"tradewind_run_{uuid.uuid4().hex}"
        (
            rows.write.format("parquet")
            .option("path", scratch_path(self.spark, "run"))
            .bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .saveAsTable(name)
        )
        self._tables.append(name)
        return self.spark.table(name)


def _not_in(rows: DataFrame, run: DataFrame) -> DataFrame:
    return rows.join(run.select(*KEY).hint("merge"), KEY, "left_anti")


def _merged(run: DataFrame, other: DataFrame) -> DataFrame:
    """Both runs as one: buckets are merged with their counterparts, nothing is shuffled between runs."""
    a, b = run.alias("a"), other.hint("merge").alias("b")
    return a.join(b, KEY, "full").select(
        *KEY,
        (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"),
        F.greatest("a.newest", "b.newest").alias("newest"),
    )


def _lower(text: Column) -> Column:
    """A-Z in lower case; texts of ASCII alone take the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(ascii_lower(text))


def line_keys(texts: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``id, th, pos, h1, h2`` of every line with a key that is long enough; ``texts`` has ``id, th, said``."""
    lines = texts.select("id", "th", F.posexplode(F.split(_lower(F.col("said")), "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    return lines.select("id", "th", "pos", key.alias("key")).where(F.char_length("key") >= least_chars).select(
        "id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")
    )


def repeated_keys(
    lines: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``h1, h2, newest`` of the keys that ``least_docs`` documents have, by adding the lines batch by batch.

    ``lines`` has ``batch``; all rows of a document are in one batch.
    """
    buckets = max(8, min(MOST_BUCKETS, -(-lines.count() // ROWS_PER_BUCKET)))
    index = LineRuns(lines.sparkSession, buckets, fanout)
    for batch in range(batches):
        own = lines.where(F.col("batch") == batch)
        index.add(own.groupBy(*KEY).agg(F.count_distinct("id").alias("docs"), F.max("id").alias("newest")))
    found = stored(index.tally().where(F.col("docs") >= least_docs).select(*KEY, "newest"), "repeated")
    index.close()
    return found


def dedupe_lines(
    documents: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``row`` (all columns of the document), ``kept`` (its text without the dropped lines), ``n_lines`` and ``n_dropped``."""
    said = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(said).alias("th"),
        said.alias("said"),
    )
    keyed = line_keys(rows.select("id", "th", "said"), least_chars)
    lines = stored(keyed.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")), "lines")
    repeated = repeated_keys(lines, least_docs, batches, fanout)
    drops = (
        lines.join(repeated, KEY)
        .where("id < newest")
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drops"))
    )
    # The lines are split before the join: after it they are an array whose items are
    # looked up, and not an expression that is evaluated for each of them.
    met = rows.select("row", "id", "th", F.split("said", "\n").alias("lines")).join(drops, ["id", "th"], "left")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.when(
        F.col("drops").isNotNull(),
        F.transform(F.array_except(places, F.col("drops")), lambda p: F.get(F.col("lines"), p)),
    ).otherwise(F.col("lines"))
    return met.select(
        "row",
        F.array_join(kept, "\n").alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_repeated_lines(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with the repeated lines taken out of their texts; nulls stay null."""
    cut = dedupe_lines(documents, text=text, **options)
    kept = F.when(F.col(f"row.`{text}`").isNotNull(), F.col("kept"))
    return cut.select(*[kept.alias(c) if c == text else F.col(f"row.`{c}`") for c in documents.columns])


def digests(cut: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of :func:`dedupe_lines`' rows."""
    return cut.select(
        F.col(f"row.`{doc_id}`").cast("long").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
