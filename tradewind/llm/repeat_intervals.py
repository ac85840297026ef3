"""Removal of long byte strings that occur more than once, by common-prefix interval trees.

Every byte covered by a string of ``length`` bytes that also starts anywhere else,
in the same text or another, is removed. Matches never cross texts.

Anchors. Of the ``length / 2``-byte substrings inside each window of ``length`` bytes
the one with the least hash is the window's anchor. Equal windows have the same
anchor at the same place, so windows can only repeat among texts that share an
anchor, and about one position in a hundred is one. All suffixes that start with
the same anchor are one stretch of the suffix array of the collection; they are
brought together by the anchor's hash.

Copies first. An anchor's windows span one string; anchors of equal hash and equal
string are counted before anything is compared, so copied passages are settled
as numbers. Texts are fetched only for stretches that also hold other strings,
one for each distinct string.

Interval tree. The suffixes of a stretch are sorted, neighbours give the array of
common prefixes, and a scan with a stack emits its intervals: all suffixes
that share so many bytes to the right. Within an interval the reversed left
contexts, sorted likewise, say how far each member agrees to the left with any
other one; members whose left extensions differ end there, so each group is
maximal, and it holds every occurrence and not just neighbours. A member's
windows are repeated where right and left agreement together reach ``length``.

A stretch of more than ``MOST_SUFFIXES`` distinct strings is not sorted in one
task: its windows are hashed each and counted by Spark, which gives the same
answer for any size.

Texts are shuffled twice at most and only those concerned, found by a bitmap of
fixed size, as are the anchors that occur twice. Windows are compared by 128 bits of hashes, suffixes byte by byte.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing;
rows that are equal in doc_id and text are occurrences of each other; rows with a
null or repeated doc_id are told apart by their text; an empty table gives no
rows; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm import word_hashes
from tradewind.llm.bitmaps import bitmap_of, has_bit
from tradewind.llm.components import stored
from tradewind.llm.worker_memory import lean

LENGTH = 400
MOST_SUFFIXES = 4096
_CHUNK = 8 << 20
_PLACE = np.uint64((1 << 24) - 1)
_KEY = ["__id", "__text"]


# --- Anchors -------------------------------------------------------------


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by running minima from both sides of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Row, anchor, first and last window (positions in their row), anchor hash and string hash."""
    gram = length // 2
    found = []
    for begin in range(0, max(1, len(data) - length + 1), _CHUNK):
        part = data[begin : begin + _CHUNK + length - 1]
        if len(part) < length:
            continue
        sums = word_hashes.prefix_sums(part)
        at = np.arange(len(part) - gram + 1)
        hashes = word_hashes.range_hashes(sums, at, at + gram)
        least = _least_in_windows((hashes & ~_PLACE) | at.astype(np.uint64), length - gram + 1) & _PLACE
        windows = np.arange(len(least)) + begin
        row = np.searchsorted(offsets, windows, side="right") - 1
        valid = windows + length <= offsets[row + 1]
        windows, row, anchor = windows[valid], row[valid], least[valid].astype(np.int64) + begin
        if not len(windows):
            continue
        new = np.ones(len(windows), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1) | (row[1:] != row[:-1])
        starts = np.flatnonzero(new)
        last = np.append(starts[1:], len(windows)) - 1
        lo, hi, anchor, row = windows[starts], windows[last], anchor[starts], row[starts]
        string = word_hashes.range_hashes(sums, lo - begin, hi + length - begin)
        string = word_hashes.mix(string + (anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        base = offsets[row]
        found.append((row, anchor - base, lo - base, hi - base, hashes[anchor - begin], string))
    if not found:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    return [np.concatenate(x) for x in zip(*found)]


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _anchor_rows(texts: DataFrame, length: int, repeated=None) -> DataFrame:
    """``h, c`` of every anchor; given a bitmap of repeated ones, with text and windows and only of those."""
    placed = repeated is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                found = anchors(*word_hashes.column_bytes(piece.column("text")), length)
                if placed:
                    again = has_bit(repeated.value, found[4])
                    found = [x[again] for x in found]
                row, at, lo, hi, h, c = found
                out = {"h": pa.array(h.view(np.int64)), "c": pa.array(c.view(np.int64))}
                if placed:
                    row = pa.array(row)
                    out |= {k: piece.column(k).take(row) for k in _KEY}
                    out |= {"at": pa.array(at), "lo": pa.array(lo), "hi": pa.array(hi)}
                yield _batch(out)

    schema = "h long, c long" + (", __id long, __text long, at long, lo long, hi long" if placed else "")
    return texts.mapInArrow(lean(run), schema)


# --- Suffix intervals ----------------------------------------------------


def _common(rows: list[bytes], width: int) -> np.ndarray:
    """Length of the common prefix of each row with the one before it; 0 for the first."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    table = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    same = np.concatenate([table[1:] == table[:-1], np.zeros((len(rows) - 1, 1), bool)], axis=1)
    out = np.zeros(len(rows), np.int64)
    out[1:] = np.minimum(same.argmin(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return out


def prefix_intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Shared length, first and last suffix of every interval, by a scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        shared = int(common[i]) if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > shared:
            size, first = stack.pop()
            yield size, first, i - 1
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


def repeated_windows(lefts: list[bytes], rights: list[bytes], length: int = LENGTH):
    """Maximal repeats around an anchor.

    ``rights`` are sorted. Yields interval, member, and the least and greatest
    distance from a repeated window's start to the anchor.
    """
    n = len(rights)
    common = _common(rights, length)
    backwards = [x[::-1] for x in lefts]
    by_left = sorted(range(n), key=backwards.__getitem__)
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    agree = _common([backwards[i] for i in by_left], length)
    for number, (shared, first, last) in enumerate(prefix_intervals(common)):
        nearest = length - shared
        if first == last:
            continue
        order = np.argsort(rank[first : last + 1])
        ranks = rank[first : last + 1][order]
        between = np.minimum.reduceat(agree[: ranks[-1] + 1], ranks[:-1] + 1)
        # Each member's longest left extension shared with any other of the interval.
        left = np.maximum(np.append(between, 0), np.append(0, between))
        for k in np.flatnonzero(left >= nearest).tolist():
            yield number, first + int(order[k]), nearest, int(left[k])


def _sorted_stretches(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated spans of the stretches that fit one task."""
    ordered = contexts.repartition("h").sortWithinPartitions("h", "right", "left")

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        out = set()
        for _, i, near, far in repeated_windows([r[0] for r in rows], [r[1] for r in rows], length):
            _, _, key, text, at, lo, hi = rows[i]
            first, last = max(lo, at - far), min(hi, at - near)
            if first <= last:
                out.add((key, text, first, last + length))
        columns = list(zip(*out)) or [()] * 4
        return _batch({n: pa.array(c, pa.int64()) for n, c in zip([*_KEY, "start", "end"], columns)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            x = batch.to_pydict()
            for h, *row in zip(*(x[c] for c in ("h", "left", "right", *_KEY, "at", "lo", "hi"))):
                if h != key:
                    if len(held) > 1:
                        yield spans(held)
                    key, held = h, []
                held.append(row)
        if len(held) > 1:
            yield spans(held)

    return ordered.select("h", "left", "right", *_KEY, "at", "lo", "hi").mapInArrow(
        lean(run), "__id long, __text long, start long, end long"
    )


# --- Spans and removal ---------------------------------------------------


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with their text key; equal rows share it."""
    said = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumns(
        {
            "__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(0)),
            "__text": F.xxhash64(F.col(doc_id).isNull(), said),
        }
    )


def _bits_of(texts: DataFrame, keys: DataFrame):
    """A broadcast bitmap of the text keys among ``keys``."""
    bits = bitmap_of(keys.select(F.xxhash64(*_KEY).alias("key")).distinct())
    return texts.sparkSession.sparkContext.broadcast(bits)


def _concerned(texts: DataFrame, shared) -> DataFrame:
    """The texts whose key is in the bitmap; others go before anything is shuffled."""
    names = texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("__key").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(has_bit(shared.value, hashes), pa.bool_())).select(names)

    return texts.withColumn("__key", F.xxhash64(*_KEY)).mapInArrow(lean(run), texts.schema)


def repeated_spans(texts: DataFrame, length: int = LENGTH, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    """``__id, __text, start, end``: spans that cover all repeated windows, overlaps included.

    ``texts`` has the key columns and ``text``.
    """
    long_texts = texts.where(F.octet_length("text") >= length)
    # Stored, so that the join's sides are both plain and one anchor of very many texts can be split.
    twice = stored(
        _anchor_rows(long_texts, length)
        .groupBy("h")
        .agg(F.count("*").alias("n"), (F.min("c") < F.max("c")).alias("mixed"))
        .where("n > 1")
        .select("h", "mixed"),
        "repeated-anchors",
    )
    bits = texts.sparkSession.sparkContext.broadcast(bitmap_of(twice.select(F.col("h").alias("key"))))
    shared = stored(_anchor_rows(long_texts, length, bits).join(twice, "h"), "anchors")
    strings = stored(
        shared.groupBy("h", "c").agg(
            F.count("*").alias("n"),
            F.min(F.struct(*_KEY, "at", "lo", "hi")).alias("one"),
            F.max("mixed").alias("mixed"),
        ),
        "strings",
    )
    settled = shared.join(strings.where("n > 1").select("h", "c"), ["h", "c"]).select(
        *_KEY, F.col("lo").alias("start"), (F.col("hi") + length).alias("end")
    )
    open_ = (
        strings.where("mixed")
        .groupBy("h")
        .agg(F.count("*").alias("strings"), F.min("n").alias("least"))
        .where("least = 1")
        .select("h", (F.col("strings") > most_suffixes).alias("large"))
    )
    asked = strings.where("mixed").join(open_, "h").select("h", "large", "one.*")
    asked = stored(asked, "suffixes")
    if asked.isEmpty():
        return settled
    per_text = asked.groupBy(*_KEY).agg(F.collect_list(F.struct("h", "large", "at", "lo", "hi")).alias("asked"))
    fetched = _concerned(long_texts, _bits_of(long_texts, asked)).join(per_text, _KEY)
    reach = length // 2

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                x = piece.to_pydict()
                out = []
                for key, text, said, asked_here in zip(x["__id"], x["__text"], x["text"], x["asked"]):
                    said = said.encode()
                    for a in asked_here:
                        at, lo, hi = a["at"], a["lo"], a["hi"]
                        if not a["large"]:
                            left, right = said[max(0, at - reach) : at], said[at : at + length]
                            out.append((a["h"], False, left, right, key, text, at, lo, hi, None))
                        else:
                            bytes_ = np.frombuffer(said[lo : hi + length], np.uint8)
                            begins = np.arange(hi - lo + 1)
                            hashes = word_hashes.range_hashes(word_hashes.prefix_sums(bytes_), begins, begins + length)
                            for p, w in enumerate(hashes.view(np.int64).tolist()):
                                out.append((a["h"], True, None, None, key, text, at, lo + p, lo + p, w))
                    if len(out) > 10_000:
                        yield _context_batch(out)
                        out = []
                yield _context_batch(out)

    found = stored(
        fetched.select(*_KEY, "text", "asked").mapInArrow(
            lean(contexts),
            "h long, large boolean, left binary, right binary, __id long, __text long, at long, lo long, hi long, w long",
        ),
        "contexts",
    )
    sorted_spans = _sorted_stretches(found.where("NOT large"), length)
    windows = found.where("large")
    again = windows.groupBy("h", "w").count().where("count > 1").select("h", "w")
    counted = windows.join(again, ["h", "w"]).select(*_KEY, F.col("lo").alias("start"), (F.col("lo") + length).alias("end"))
    return settled.unionByName(sorted_spans).unionByName(counted)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 6]
    names = ["h", "large", "left", "right", *_KEY, "at", "lo", "hi", "w"]
    columns = list(zip(*rows)) or [()] * len(names)
    return _batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_ADDED = ("n_bytes", "n_removed", "n_spans", "kept", "remaining")


# Bytes, removed bytes, removed runs, and what is left.
_Cut = tuple[int, int, int, bytes]


def cut_repeats(
    documents: DataFrame,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    most_suffixes: int = MOST_SUFFIXES,
) -> DataFrame:
    """All columns, with ``n_bytes, n_removed, n_spans``, the remaining bytes as ``kept`` and their
    whole characters as ``remaining``.

    The added columns replace columns of the same names.
    """
    own = [f for f in documents.schema.fields if f.name not in _ADDED]
    counts = [T.StructField(c, T.LongType()) for c in _ADDED[:3]]

    def finish(piece: pa.RecordBatch, cuts: list[_Cut]) -> pa.RecordBatch:
        names = [f.name for f in own]
        added = [pa.array([c[k] for c in cuts], pa.int64()) for k in range(3)]
        kept = pa.array([c[3] for c in cuts], pa.binary())
        remaining = pa.array([c[3].decode("utf-8", "ignore") for c in cuts], pa.string())
        return pa.RecordBatch.from_arrays([*map(piece.column, names), *added, kept, remaining], names=[*names, *_ADDED])

    left = [T.StructField("kept", T.BinaryType()), T.StructField("remaining", T.StringType())]
    schema = T.StructType([*own, *counts, *left])
    return _cut(documents, length, doc_id, text, most_suffixes, finish, schema)


def _under(names: list[str], finish):
    """``finish`` with rows under these names."""
    return lambda piece, cuts: finish(pa.RecordBatch.from_arrays(piece.columns, names=names), cuts)


def _cut(documents: DataFrame, length: int, doc_id: str, text: str, most_suffixes: int, finish, schema) -> DataFrame:
    """``finish(rows, their cuts)`` over all rows. Texts without a repeat are finished where they
    lie; the others meet their spans."""
    names = documents.columns
    # Own names inside, so that no column of the documents clashes with an added one.
    inner = [f"c{n}" for n in range(len(names))]
    doc_id, text = inner[names.index(doc_id)], inner[names.index(text)]
    finish = _under(names, finish)
    keyed = _keyed(documents.toDF(*inner), doc_id, text)
    texts = keyed.select(*_KEY, F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = stored(repeated_spans(texts, length, most_suffixes).distinct(), "spans")
    per_text = spans.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    shared = _bits_of(keyed, spans)
    hit = _concerned(keyed, shared).join(per_text, _KEY, "left")

    def cut(said: str | None, found) -> _Cut:
        said = (said or "").encode()
        cuts = merged([(s["start"], s["end"]) for s in found or ()])
        places = [0, *(x for cut in cuts for x in cut), len(said)]
        kept = b"".join(said[a:b] for a, b in zip(places[::2], places[1::2]))
        return len(said), len(said) - len(kept), len(cuts), kept

    def with_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, text):
                pairs = zip(piece.column(text).to_pylist(), piece.column("__spans").to_pylist())
                yield finish(piece.select(inner), [cut(said, found) for said, found in pairs])

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("__key").to_numpy(zero_copy_only=False).view(np.uint64)
            clean = batch.filter(pa.array(~has_bit(shared.value, hashes), pa.bool_())).select(inner)
            for piece in word_hashes.slices(clean, text):
                yield finish(piece, [cut(said, None) for said in piece.column(text).to_pylist()])

    untouched = keyed.withColumn("__key", F.xxhash64(*_KEY)).mapInArrow(lean(without), schema)
    return hit.mapInArrow(lean(with_spans), schema).unionByName(untouched)


def digests(cut: DataFrame, doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of :func:`cut_repeats`' rows, and the remaining ``text`` if wanted."""
    return cut.select(
        F.col(doc_id).cast("long").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"), *([F.col("remaining").alias("text")] if with_text else []),
    )


def without_repeats(documents: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated strings cut out of their texts.

    A cut inside a character removes the character's other bytes too; nulls stay null.
    """

    def finish(piece: pa.RecordBatch, cuts: list[_Cut]) -> pa.RecordBatch:
        said = [
            old if not removed else kept.decode("utf-8", "ignore")
            for old, (_, removed, _, kept) in zip(piece.column(text).to_pylist(), cuts)
        ]
        at = piece.schema.get_field_index(text)
        return piece.set_column(at, text, pa.array(said, pa.string()))

    return _cut(documents, length, doc_id, text, MOST_SUFFIXES, finish, documents.schema)
