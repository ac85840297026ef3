"""Hard negatives for contrastive training, by slot-decomposed selection.

For an anchor and each of its positives, the ``negatives`` best rows of other labels
are wanted whose score lies between two shares of the positive's score. The windows of
one anchor overlap, and every row is a candidate of several.

Slots. An anchor's positives in order of score have rising upper limits. The limits
split all scores into disjoint slots, one for each positive, and a candidate belongs
to one: that of the least limit it does not pass. Combiners keep the best ``negatives``
of a slot, whatever the number of candidates. The best of a window are then among its
slot and those below: slots are merged upwards, which keeps the best of all scores
under each limit in descending order, and a window takes those that reach its lower
limit. So one pass over the candidates answers all windows.

Scores. Rows and anchors are packed into blocks, matrices of bounded size. Blocks of
rows are dealt into groups by a hash, each block of anchors goes to every group, and a
merge join brings each pair of blocks together once; the anchors are a stated query set
against all rows. A task streams the pairs of its groups block of anchors by block, and
keeps one small table for the block at hand. A first pass of that kind over rows of equal
labels gives the positives, a second one over the others gives the slots. Between tasks
only the best of each anchor (and slot) travel, and a window over one anchor and slot
merges them, so a label or a vector that a third of all rows share is no hot key.

Components are floored to integers, which makes sums exact in doubles below 2**53;
blocks that could pass that are summed in 64-bit integers, and scores that do not fit
these stop the job.

Defined results: rows without an id, label or vector, or with a component that is null
or not finite take no part; an anchor or row that repeats in all of id, label and vector
counts once, and rows that share only an id are rows of their own; ties go to the smaller
id; a shorter vector is filled with zeros, so an empty one scores 0 with every row; an
anchor without positives, or a window without rows, gives nothing; an empty table gives
no rows; extra columns are ignored. A very long vector is one row of its block; blocks
are cut by bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.components import stored
from tradewind.llm.worker_memory import lean

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST_PERCENT = 50
MOST_PERCENT = 95
BLOCK_ROWS = 1024
BLOCK_BYTES = 2 << 20
ROWS_PER_GROUP = 4096


# --- Vectors and blocks --------------------------------------------------


def scaled_vectors(
    embeddings: DataFrame, scale: int = SCALE, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """``id, label, v`` of the rows that take part, each once; components are floored after scaling."""
    components = F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("double"))
    usable = (
        F.col(vec_id).isNotNull()
        & F.col(label).isNotNull()
        & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    return (
        embeddings.where(usable)
        .select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), components.alias("v"))
        .distinct()
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix, shorter rows filled with zeros."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes)
    out[row, place] = values[offsets[0] : offsets[-1]]
    return out


def _smallest_kind(matrix: np.ndarray) -> str:
    most = np.abs(matrix).max(initial=0)
    return next((k for k in ("int16", "int32") if most <= np.iinfo(k).max), "float64")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows ``id, label, v`` and other long columns packed into blocks, by id within a block."""
    others = [c for c in rows.columns if c not in ("id", "label", "v")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(table: pa.Table) -> pa.RecordBatch:
            table = table.sort_by("id")
            matrix = _matrix(table.column("v").combine_chunks())
            kind = _smallest_kind(matrix)
            longs = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label", *others)]
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.array([x], pa.binary()) for x in [*longs, matrix.astype(kind).tobytes()]),
                    pa.array([kind]),
                    pa.array([matrix.shape[1]], pa.int64()),
                ],
                names=["ids", "labels", *others, "vectors", "kind", "size"],
            )

        held, n, size = [], 0, 0
        for batch in batches:
            width = 8 * max(1, int(np.diff(batch.column("v").cast(pa.large_list(pa.float64())).offsets).max(initial=0)))
            step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // width))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                if held and (n + part.num_rows > BLOCK_ROWS or size + width * part.num_rows > BLOCK_BYTES):
                    yield packed(pa.Table.from_batches(held))
                    held, n, size = [], 0, 0
                held.append(part)
                n, size = n + part.num_rows, size + width * part.num_rows
        if n:
            yield packed(pa.Table.from_batches(held))

    schema = ", ".join(["ids binary, labels binary", *(f"{c} binary" for c in others), "vectors binary, kind string, size long"])
    return rows.mapInArrow(lean(run), schema)


class Block:
    """Ids, labels and vectors of a block, and the other long columns asked for."""

    def __init__(self, row: dict, side: str, others: tuple[str, ...] = ()):
        self.ids, self.labels, *rest = (
            np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("ids", "labels", *others)
        )
        self.others = dict(zip(others, rest))
        self.vectors = np.frombuffer(row[f"{side}_vectors"], row[f"{side}_kind"]).reshape(
            len(self.ids), row[f"{side}_size"]
        )


def _scores(a: Block, b: Block) -> np.ndarray:
    """Integer inner products of all vectors of two blocks."""
    size = min(a.vectors.shape[1], b.vectors.shape[1])
    x, y = a.vectors[:, :size], b.vectors[:, :size]
    bound = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0)) * size
    if bound < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return x.astype(np.int64) @ y.astype(np.int64).T
    raise ArithmeticError("inner products beyond 64 bits")


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` greatest allowed scores of each row; of equal ones the first columns."""
    least = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, least)
    if masked.shape[1] > k:
        bar = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k, None]
        above = masked > bar
        level = masked == bar
        room = k - above.sum(axis=1, keepdims=True)
        chosen = above | (level & (np.cumsum(level, axis=1) <= room))
    else:
        chosen = np.ones(masked.shape, bool)
    return np.nonzero(chosen & allowed)


class _Best:
    """The best ``k`` of every (anchor, slot) of one block of anchors, so far."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.zeros((0, 4), np.int64)  # anchor's place, slot, score, id

    def add(self, place: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([place, slot, score, ids], 1)])
        rows = rows[np.lexsort((rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        begin = np.flatnonzero(new)
        rank = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
        self.rows = rows[rank < self.k]


# --- Passes over all pairs of blocks -------------------------------------


def _groups(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_GROUP))


def _passed(anchors: DataFrame, rows: DataFrame, groups: int, others: tuple[str, ...], k: int, pick: Callable) -> DataFrame:
    """``anchor, slot, score, id``: the best of each task. ``pick(anchors, rows, scores)`` yields
    (slot, allowed) masks of a pair of blocks.

    Blocks of anchors are the left side of the merge join, so all partners of one
    come together. A result does not depend on it: a block that comes again starts anew.
    """
    side = lambda frame, name: frame.select(
        "group", *[F.col(c).alias(f"{name}_{c}") for c in frame.columns if c != "group"]
    )
    dealt = anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    own = rows.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    pairs = side(dealt, "a").join(side(own, "b").hint("merge"), "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, best = None, None, _Best(k)

        def out() -> pa.RecordBatch:
            place, slot, score, ids = best.rows.T
            columns = [block.ids[place], slot, score, ids, block.others["row"][place]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor", "slot", "score", "id", "row"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if (row["group"], row["a_number"]) != key:
                    if block is not None:
                        yield out()
                    key, block, best = (row["group"], row["a_number"]), Block(row, "a", ("row", *others)), _Best(k)
                other = Block(row, "b")
                scores = _scores(block, other)
                for slot, allowed in pick(block, other, scores):
                    place, column = _best(scores, allowed, k)
                    best.add(place, np.full(len(place), slot), scores[place, column], other.ids[column])
        if block is not None:
            yield out()

    return pairs.mapInArrow(lean(run), "anchor long, slot long, score long, id long, row long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every anchor and slot, from those of the tasks."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _same_rows(a: Block, b: Block) -> np.ndarray | None:
    """Which pairs are one row beside itself; None if there are none."""
    if not np.isin(a.ids, b.ids).any():
        return None
    same = (a.ids[:, None] == b.ids) & (a.labels[:, None] == b.labels)
    size = max(a.vectors.shape[1], b.vectors.shape[1])
    wide = lambda x: np.pad(x.vectors.astype(np.float64), ((0, 0), (0, size - x.vectors.shape[1])))
    x, y = wide(a), wide(b)
    i, j = np.nonzero(same)
    same[i, j] = (x[i] == y[j]).all(axis=1)
    return same


def _positives(a: Block, b: Block, scores: np.ndarray):
    allowed = a.labels[:, None] == b.labels
    same = _same_rows(a, b)
    yield 0, allowed if same is None else allowed & ~same


def _negatives(positives: int):
    def pick(a: Block, b: Block, scores: np.ndarray):
        other_label = a.labels[:, None] != b.labels
        for slot in range(positives):
            low, high, below = (a.others[f"{x}{slot}"][:, None] for x in ("low", "high", "below"))
            allowed = (scores > below) & (scores <= high) & (scores >= low) & other_label
            if allowed.any():
                yield slot, allowed

    return pick


# --- The operator --------------------------------------------------------


def _percent_of(percent: int, score: str, up: bool) -> Column:
    """A share of an integer in whole percent, rounded up or down; no step passes 64 bits."""
    rest = f"(pmod({score}, 100) * {percent} + {99 if up else 0}) div 100"
    return F.expr(f"(({score} - pmod({score}, 100)) div 100) * {percent} + {rest}")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``id, label, v``."""
    rows = stored(vectors, "vectors")
    groups = _groups(rows.count())
    blocks = stored(_blocks(rows), "row-blocks")
    # Rows that share an id are told apart by all they hold.
    queries = rows.where(is_anchor).withColumn("row", F.xxhash64("id", "label", "v"))
    number = F.xxhash64("ids", "labels", "vectors").alias("number")

    asked = stored(_blocks(queries).select("*", number), "anchor-blocks")
    found = stored(_passed(asked, blocks, groups, (), positives, _positives), "found")
    chosen = _merged(found, positives).select(
        "row", F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # Positives in rising order of score; those of equal score share the slot of the first.
    rising = Window.partitionBy("row").orderBy("positive_score", "positive_id")
    limited = chosen.withColumns(
        {
            "low": _percent_of(least_percent, "positive_score", up=True),
            "high": _percent_of(most_percent, "positive_score", up=False),
            "slot": F.row_number().over(rising) - 1,
        }
    )
    windows = stored(limited, "windows")
    at = lambda name, k: F.max(F.when(F.col("slot") == k, F.col(name)))
    # A slot that no positive has takes nothing: its lower limit is over its upper one.
    limits = windows.groupBy("row").agg(
        *[F.coalesce(at("low", k), F.lit(1)).alias(f"low{k}") for k in range(positives)],
        *[F.coalesce(at("high", k), F.lit(0)).alias(f"high{k}") for k in range(positives)],
        *[F.coalesce(at("high", k - 1) if k else F.lit(None), F.lit(-(1 << 63))).alias(f"below{k}") for k in range(positives)],
    )
    others = tuple(f"{x}{k}" for x in ("low", "high", "below") for k in range(positives))
    limited_queries = stored(_blocks(queries.join(limits, "row")).select("*", number), "anchor-blocks")
    slots = stored(_passed(limited_queries, blocks, groups, others, negatives, _negatives(positives)), "slots")
    return _answers(windows, _merged(slots, negatives), negatives)


def _answers(windows: DataFrame, slots: DataFrame, negatives: int) -> DataFrame:
    """Every window's best, by merging the slots of an anchor upwards."""
    per_anchor = slots.groupBy("row").agg(F.collect_list(F.struct("slot", "score", "id")).alias("kept"))
    asked = windows.groupBy("row").agg(
        F.first("anchor_id").alias("anchor_id"),
        F.collect_list(F.struct("slot", "positive_id", "positive_score", "low")).alias("windows"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            x = batch.to_pydict()
            for anchor, wanted, kept in zip(x["anchor_id"], x["windows"], x["kept"]):
                best: list[tuple[int, int]] = []
                for window in sorted(wanted, key=lambda w: w["slot"]):
                    new = [(-c["score"], c["id"]) for c in kept if c["slot"] == window["slot"]]
                    best = sorted([*new, *best])[:negatives]
                    fits = [b for b in best if -b[0] >= window["low"]]
                    out += [
                        (anchor, window["positive_id"], rank, b[1], window["positive_score"], -b[0])
                        for rank, b in enumerate(fits, 1)
                    ]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return asked.join(per_anchor, "row").mapInArrow(lean(run), schema)
