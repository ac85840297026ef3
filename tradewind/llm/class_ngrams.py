"""Language-model scoring with a Brown class-based bigram model.

P(word | word before) = P(class | class before) * P(word | class). Classes come
from exchange clustering: every unit is moved to the class that raises the
likelihood of the corpus' class bigrams most, in sweeps until no move helps.

All training words are clustered, in two steps. The first gives classes to units: the
``core`` most frequent words, and pools of all other words with the same ending. Bigrams
of units are counted over the whole corpus; their table is bounded by the number of
units squared and is what the driver clusters. In the second step every word outside the
core, however rare, goes to the class that its own neighbours in the corpus favour most:
an exchange sweep of all words at once, at the units' class statistics. Neighbours' classes
are counted for each word and joined by a shuffle on the word. A pool's class is kept
for words that training has not seen. Words, their counts and classes are not bounded
and never leave the executors.

Scoring needs count and class of every word of every text. Texts are dealt into blocks
of about ``BLOCK_BYTES``; each block asks once for each of its distinct words, the
requests are joined to the words, and answers and texts of a block meet again.
What is shuffled is the text once, the distinct words of blocks twice, and neighbours'
classes of the words of slices. A text leaves its class pairs and emissions; the training
texts' pairs add up to the class bigrams, and with these all texts are scored.

Words are compared by 64-bit hashes. Tokens are words and one end per text.

Defined results: a null or empty text is its end token alone; repeated rows are
counted and scored each; a null doc_id is trained on or held out by the crc32 of
an empty text; without training rows all counts are zero; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import word_hashes
from tradewind.llm.components import stored
from tradewind.llm.tables import crc_remainder
from tradewind.llm.worker_memory import lean

BLOCK_BYTES = 16 << 20
_COUNT_SLICE = 16 << 20


@dataclass(frozen=True)
class Parameters:
    core: int = 511
    pools: int = 128
    classes: int = 48
    sweeps: int = 20
    back_off: float = 20.0


@dataclass(frozen=True)
class Model:
    """Classes of the units, class totals and corpus totals; its size is bounded by the parameters."""

    core: np.ndarray  # hashes of the core words, sorted
    unit_class: np.ndarray  # of core words, pools and, last, the end
    tokens: np.ndarray  # training tokens of each class
    words: np.ndarray  # distinct words of each class
    total: int
    distinct: int
    ends: int
    parameters: Parameters

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 P(word | class)."""
        return np.log10((counts + 0.5) / (self.tokens[classes] + 0.5 * (self.words[classes] + 1)))


def transitions(bigrams: np.ndarray, back_off: float) -> np.ndarray:
    """log10 P(class | class before), backed off to the class shares."""
    tokens = bigrams.sum(axis=0)
    share = (tokens + 0.5) / (tokens.sum() + 0.5 * len(tokens))
    return np.log10((bigrams + back_off * share[None, :]) / (bigrams.sum(axis=1, keepdims=True) + back_off))


def _pool(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pools: int) -> np.ndarray:
    """A pool for each word by its last two bytes."""
    last = word_hashes.LOWER[data[ends - 1]].astype(np.uint64)
    before = np.where(ends - starts > 1, word_hashes.LOWER[data[np.maximum(ends - 2, 0)]], 0).astype(np.uint64)
    return (word_hashes.mix(last * np.uint64(256) + before) % np.uint64(pools)).astype(np.int64)


def _units(core: np.ndarray, hashes: np.ndarray, pools: np.ndarray) -> np.ndarray:
    if not len(core):
        return pools
    at = np.minimum(np.searchsorted(core, hashes), len(core) - 1)
    return np.where(core[at] == hashes, at, len(core) + pools)


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def word_counts(texts: DataFrame, parameters: Parameters = Parameters()) -> DataFrame:
    """``word, pool, n`` of every distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for large in word_hashes.slices(batch, "text", _COUNT_SLICE):
                words, pools = [], []
                for piece in word_hashes.slices(large, "text"):
                    data, offsets = word_hashes.column_bytes(piece.column("text"))
                    starts, ends, hashes, _ = word_hashes.words(data, offsets)
                    words.append(hashes)
                    pools.append(_pool(data, starts, ends, parameters.pools) if len(starts) else starts)
                words, pools = np.concatenate(words), np.concatenate(pools)
                found, first, counts = np.unique(words, return_index=True, return_counts=True)
                yield _batch(
                    {"word": pa.array(found.view(np.int64)), "pool": pa.array(pools[first]), "n": pa.array(counts)}
                )

    return texts.mapInArrow(lean(run), "word long, pool long, n long").groupBy("word", "pool").agg(F.sum("n").alias("n"))


def unit_bigrams(texts: DataFrame, core: np.ndarray, parameters: Parameters) -> np.ndarray:
    """Counts of neighbouring units; the end stands before each text's first word."""
    units = len(core) + parameters.pools + 1
    shared = texts.sparkSession.sparkContext.broadcast(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(units * units, np.int64)
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                sequence, _ = _sequences(piece.column("text"), shared.value, parameters)
                table += np.bincount(sequence[:-1] * units + sequence[1:], minlength=units * units)
        pairs = np.flatnonzero(table)
        yield _batch({"pair": pa.array(pairs), "n": pa.array(table[pairs])})

    rows = texts.mapInArrow(lean(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(units * units)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(units, units)


def _sequences(column: pa.Array, core: np.ndarray, parameters: Parameters):
    """Units of all texts with an end before the first and after each text, and the words' hashes."""
    data, offsets = word_hashes.column_bytes(column)
    starts, ends, hashes, bounds = word_hashes.words(data, offsets)
    pools = _pool(data, starts, ends, parameters.pools) if len(starts) else starts
    end = len(core) + parameters.pools
    sequence = np.full(len(hashes) + len(bounds), end, np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    sequence[np.arange(len(hashes)) + row + 1] = _units(core, hashes, pools)
    return sequence, (hashes, bounds)


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange_clusters(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """A class for each unit. The last unit, the end, keeps the last class to itself."""
    units = len(pairs)
    size = pairs.sum(axis=1) + pairs.sum(axis=0)
    of = np.zeros(units, np.int64)
    order = np.argsort(-size[:-1], kind="stable")
    of[order] = np.arange(units - 1) % max(1, classes - 1)
    of[-1] = classes - 1
    member = np.zeros((units, classes))
    member[np.arange(units), of] = 1
    table = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for u in order.tolist():
            if not size[u]:
                continue
            old, own = of[u], pairs[u, u]
            member[u, old] = 0
            right, left = pairs[u] @ member, pairs[:, u] @ member
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own
            # The classes beside the unit get its bigrams in their marginals wherever it goes.
            rows, columns = table.sum(axis=1) + left, table.sum(axis=0) + right
            gain = (_entropy(table + right) - _entropy(table)).sum(axis=1)
            gain += (_entropy(table + left[:, None]) - _entropy(table)).sum(axis=0)
            same = np.diag(table)
            gain += _entropy(same + right + left + own) + _entropy(same) - _entropy(same + right) - _entropy(same + left)
            out, into = right.sum() + own, left.sum() + own
            gain -= _entropy(rows + out) - _entropy(rows) + _entropy(columns + into) - _entropy(columns)
            gain[-1] = -np.inf
            new = int(np.argmax(gain))
            if gain[old] >= gain[new] - 1e-9:
                new = int(old)
            member[u, new] = 1
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            of[u] = new
            moved += new != old
        if not moved:
            break
    return of


def neighbour_classes(texts: DataFrame, core: np.ndarray, of: np.ndarray, parameters: Parameters) -> DataFrame:
    """``word, slots, times``: how often a class stands before (slot: the class) or after (slot: classes + the
    class) each word outside the core, a row for each word of a slice, as bytes of 16 and 32 bits a number."""
    shared = texts.sparkSession.sparkContext.broadcast((core, of))
    slots = 2 * parameters.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, of = shared.value
        for batch in batches:
            for large in word_hashes.slices(batch, "text", _COUNT_SLICE):
                words, places = [], []
                for piece in word_hashes.slices(large, "text"):
                    sequence, (hashes, bounds) = _sequences(piece.column("text"), core, parameters)
                    at = np.arange(len(hashes)) + np.repeat(np.arange(1, len(bounds)), np.diff(bounds))
                    some = (sequence[at] >= len(core)).nonzero()[0]
                    classes, at = of[sequence], at[some]
                    words += [hashes[some], hashes[some]]
                    places += [classes[at - 1], classes[at + 1] + parameters.classes]
                found, word = np.unique(np.concatenate(words), return_inverse=True)
                pairs, n = np.unique(word * slots + np.concatenate(places), return_counts=True)
                cuts = np.searchsorted(pairs // slots, np.arange(len(found) + 1))
                yield _batch(
                    {
                        "word": pa.array(found.view(np.int64)),
                        "slots": _packed((pairs % slots).astype(np.int16), cuts),
                        "times": _packed(n.astype(np.int32), cuts),
                    }
                )

    return texts.mapInArrow(lean(run), "word long, slots binary, times binary")


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the values between cuts."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].copy().view(kind), np.diff(offsets) // size


def best_classes(neighbours: np.ndarray, bigrams: np.ndarray, back_off: float) -> np.ndarray:
    """The class that gains most likelihood from each word's neighbours; the last, the end's, takes none.

    Rows of ``neighbours`` count the classes before and after a word. The gain is that of
    :func:`exchange_clusters` at class statistics that stay as they are.
    """
    classes = len(bigrams)
    after = transitions(bigrams, back_off)
    share = bigrams.sum(axis=0) + 0.5
    before = after - np.log10(share / share.sum())
    gain = neighbours[:, classes:] @ after.T + neighbours[:, :classes] @ before
    gain[:, -1] = -np.inf
    return gain.argmax(axis=1)


def word_classes(neighbours: DataFrame, bigrams: np.ndarray, parameters: Parameters) -> DataFrame:
    """``word, class`` of every word with neighbours."""
    slots = 2 * parameters.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(slots)  # the word that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            (slot, many), (n, _) = _unpacked(batch.column("slots"), np.int16), _unpacked(batch.column("times"), np.int32)
            found, row = np.unique(batch.column("word").to_numpy(), return_inverse=True)
            row = np.repeat(row, many)
            table = np.bincount(row * slots + slot, n, len(found) * slots).reshape(-1, slots)
            if last is not None and found[0] == last:
                table[0] += held
            elif last is not None:
                found, table = np.append(last, found), np.vstack([held, table])
            last, held = found[-1], table[-1]
            if len(found) > 1:
                of = best_classes(table[:-1], bigrams, parameters.back_off)
                yield _batch({"word": pa.array(found[:-1]), "class": pa.array(of)})
        if last is not None:
            of = best_classes(held[None, :], bigrams, parameters.back_off)
            yield _batch({"word": pa.array([int(last)], pa.int64()), "class": pa.array(of)})

    ordered = neighbours.repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(lean(run), "word long, class long")


def train(texts: DataFrame, counts: DataFrame, parameters: Parameters = Parameters()) -> tuple[Model, DataFrame]:
    """A model of training ``texts`` (column ``text``) and their stored word counts, and the stored
    ``word, n, class`` of all words, the class of core words being null."""
    ends = texts.count()
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(parameters.core).select("word", "n").toArrow()
    core, times = (top[c].to_numpy().astype(np.int64) for c in ("word", "n"))
    order = np.argsort(core.view(np.uint64))
    core, times = core.view(np.uint64)[order], times[order]
    pairs = unit_bigrams(texts, core, parameters)
    of = exchange_clusters(pairs, parameters.classes, parameters.sweeps)
    member = np.eye(parameters.classes)[of]
    start = member.T @ pairs @ member
    assigned = word_classes(neighbour_classes(texts, core, of, parameters), start, parameters)
    words = stored(counts.select("word", "n").join(assigned, "word", "left"), "word-classes")
    tokens = np.bincount(of[: len(core)], times, parameters.classes)
    distinct = np.bincount(of[: len(core)], minlength=parameters.classes).astype(float)
    for r in words.where("class IS NOT NULL").groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        tokens[r[0]] += r[1]
        distinct[r[0]] += r[2]
    tokens[-1], distinct[-1] = ends, ends > 0
    model = Model(
        core, of, tokens, distinct, int(totals["n"] or 0) + ends, int(totals["words"]) + (ends > 0), ends, parameters
    )
    return model, words


def _pair_sums(parts: DataFrame, classes: int) -> np.ndarray:
    """Class bigrams of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(classes * classes, np.int64)
        for batch in batches:
            pairs, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            table += np.bincount(pairs, n, len(table)).astype(np.int64)
        found = np.flatnonzero(table)
        yield _batch({"pair": pa.array(found), "n": pa.array(table[found])})

    learnt = parts.where("NOT held_out").select("pairs", "times")
    rows = learnt.mapInArrow(lean(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(classes * classes)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(classes, classes)


def score(rows: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of ``doc_id, held_out, text``."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-size // BLOCK_BYTES), min(partitions, size >> 20))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition("block")

    def distinct(table: pa.Table) -> pa.Table:
        found = []
        for batch in table.combine_chunks().to_batches():
            for piece in word_hashes.slices(batch, "text"):
                found.append(np.unique(word_hashes.words(*word_hashes.column_bytes(piece.column("text")))[2]))
        words = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        block = table.column("block")[0].as_py()
        return pa.table({"block": pa.array(np.full(len(words), block)), "word": pa.array(words.view(np.int64))})

    asked = dealt.groupBy("block").applyInArrow(distinct, "block long, word long")
    answers = asked.join(words, "word").select("block", "word", "n", F.coalesce("class", F.lit(-1)).alias("class"))
    shared = spark.sparkContext.broadcast(model)
    kinds = pa.schema(
        [
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("emission", pa.float64()),
            ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
        ]
    )

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        model = shared.value
        words = known.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        words, n = words[order], known.column("n").to_numpy()[order]
        given = known.column("class").to_numpy()[order]
        classes_ = model.parameters.classes
        out = []
        for batch in texts.combine_chunks().to_batches():
            for piece in word_hashes.slices(batch, "text"):
                sequence, (hashes, bounds) = _sequences(piece.column("text"), model.core, model.parameters)
                at = np.minimum(np.searchsorted(words, hashes), max(0, len(words) - 1))
                found = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
                # Each text's tokens: its words, then the end.
                firsts = bounds[:-1] + np.arange(len(bounds) - 1)
                tokens = np.full(len(hashes) + len(bounds) - 1, float(model.ends))
                place = np.arange(len(hashes)) + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                tokens[place] = np.where(found, n[at] if len(words) else 0, 0)
                classes = model.unit_class[sequence]
                if len(words):
                    own = np.where(found & (given[at] >= 0), given[at], classes[place + 1])
                    classes[place + 1] = own
                base = np.log10((tokens + 0.5) / (model.total + 0.5 * (model.distinct + 1)))
                emission = model.emission(tokens, classes[1:])
                rows = piece.num_rows
                row = np.repeat(np.arange(rows), np.diff(bounds) + 1)
                pairs, times = np.unique((row * classes_ + classes[:-1]) * classes_ + classes[1:], return_counts=True)
                cuts = pa.array(np.searchsorted(pairs // classes_**2, np.arange(rows + 1)).astype(np.int32))
                out.append(
                    pa.Table.from_arrays(
                        [
                            piece.column("doc_id"),
                            piece.column("held_out"),
                            pa.array(np.diff(bounds) + 1),
                            pa.array(np.add.reduceat((tokens > 0).astype(np.int64), firsts)),
                            pa.array(np.full(rows, model.total)),
                            pa.array(np.add.reduceat(base, firsts)),
                            pa.array(np.add.reduceat(emission, firsts)),
                            pa.ListArray.from_arrays(cuts, pa.array((pairs % classes_**2).astype(np.int32))),
                            pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                        ],
                        schema=kinds,
                    )
                )
        return pa.concat_tables(out) if out else kinds.empty_table()

    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double"
    parts = stored(
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(run, columns + ", emission double, pairs array<int>, times array<int>"),
        "class-pairs",
    )
    parameters = model.parameters
    moves = transitions(_pair_sums(parts, parameters.classes), parameters.back_off).ravel()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            # Every text has a pair: its end follows something.
            firsts = np.append(0, np.cumsum(batch.column("pairs").value_lengths().to_numpy())[:-1])
            added = np.add.reduceat(moves[pairs] * n, firsts)
            emitted = batch.column("emission").to_numpy(zero_copy_only=False)
            kept = batch.columns[:6]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(emitted + added)], names=[*batch.schema.names[:6], "score"])

    return parts.mapInArrow(lean(total), columns + ", score double")


def score_documents(
    documents: DataFrame, parameters: Parameters = Parameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Scores of all documents under a model of those whose crc32 of the id modulo 5 is not 1."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (crc_remainder(doc_id, 5) == 1).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    learnt = rows.where("NOT held_out").select("text")
    counts = stored(word_counts(learnt, parameters), "words")
    model, words = train(learnt, counts, parameters)
    return score(rows, words, model)
