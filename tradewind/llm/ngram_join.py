"""Similarity self-join of documents on sets of word shingles, by token-combination prefixes.

A document's set holds its distinct five-word shingles. Two documents link when
the Jaccard similarity of their sets is at least ``percent`` of a hundred.
Documents with the same set are one class, and the join is between classes.

Order. Shingles are ordered by a hash, frequent ones after rare ones. Which are
frequent is decided by counting over all documents those that recur within a
slice of text; the answer is a bitmap of fixed size that goes to every task. The
bitmap only sets the order, so its collisions cost nothing but speed.

Index. Linked sets of n shingles share at least ceil(0.75 n) of them, so their
prefixes of n - ceil(0.75 n) + 2 shingles share two. Every rare shingle of a
prefix is indexed by itself. Frequent ones, which a prefix holds only when three
quarters of the document are frequent, are indexed by pairs; a document with more
than ``MOST_PAIRED`` of them indexes them by themselves, and the others add single
entries that are matched with such documents only.

Candidates. A list of up to ``SHORT_LIST`` classes gives all its pairs. As linked sets
share two shingles of their prefixes, a pair that meets once in all short lists goes
before anything is fetched for it, unless both prefixes hold a frequent shingle, which
may be the second one; a shared pair of frequent ones counts for two. Pairs whose second
meeting is in a long list are found there. A longer
one gives the pairs with its hub, the class with the most copies, or else with the
largest share of its shingles in long lists, which is the one that near copies
have in common. When the links found so far leave a long list with several
components, the pairs between these follow, a list
in blocks of ``BLOCK`` classes. So a group of thousands of near copies is linked
without all its pairs, and no link between components is lost; ``link_counts`` looks at all pairs
of long lists in this way. Candidates pass a
bound on their overlap from bitmaps of the sets, and then the sets themselves are
compared.

Nothing unbounded is collected or broadcast: the driver sees two bitmaps of
``BITMAP_BITS`` bits. Lists are streamed from sorted partitions.

Sets are compared by 64-bit shingle hashes and classes by a 64-bit hash of the
set; a false class needs a collision, about n^2 / 2^65 for n classes.

Defined results: a null or empty text, or one without words, has no shingles and
is its own component; a text with fewer words than a shingle has its whole
sequence as its one shingle; repeated rows are copies; rows with the same doc_id
and different texts are judged apart; a null doc_id takes part, and counts for the
least doc_id of a component only if no other exists; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import word_hashes
from tradewind.llm.bitmaps import bitmap_of, has_bit
from tradewind.llm.components import connected_components, stored
from tradewind.llm.worker_memory import lean

PERCENT = 75
SHORT_LIST = 32
MOST_PAIRED = 12
BLOCK = 2000
FREQUENT_IN_SLICE = 3
FREQUENT = 24
_SLICE = 8 << 20
_SEED = np.uint64(0xD6E8FEB86659FD93)


# --- Sets ----------------------------------------------------------------


def _sets(column: pa.Array, hot: np.ndarray | None = None):
    """Distinct shingle hashes of each row in the global order, and each row's range."""
    _, _, hashes, bounds = word_hashes.words(*word_hashes.column_bytes(column))
    values, ranges = word_hashes.shingles(hashes, bounds)
    rows = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
    late = has_bit(hot, values) if hot is not None else np.zeros(len(values), bool)
    order = np.lexsort((values, late, rows))
    values, rows, late = values[order], rows[order], late[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows, late = values[keep], rows[keep], late[keep]
    return values, np.searchsorted(rows, np.arange(len(ranges))), late


def _nodes(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """A hash of each row's set, whatever its order."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word_hashes.mix(values ^ _SEED))])
    return word_hashes.mix(sums[ranges[1:]] - sums[ranges[:-1]] + np.diff(ranges).astype(np.uint64)).view(np.int64)


def _seen_once(nodes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows are the first of their class in this task; ``seen`` is kept small."""
    keep = np.zeros(len(nodes), bool)
    for at, node in enumerate(nodes.tolist()):
        if node not in seen:
            if len(seen) < 1_000_000:
                seen.add(node)
            keep[at] = True
    return keep


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Bitmap of the shingles that occur in very many classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, "text", _SLICE):
                parts, seen = [], set()
                for small in word_hashes.slices(piece, "text"):
                    values, ranges, _ = _sets(small.column("text"))
                    first = _seen_once(_nodes(values, ranges), seen)
                    parts.append(values[np.repeat(first, np.diff(ranges))])
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                many = counts >= FREQUENT_IN_SLICE
                yield _batch({"key": pa.array(keys[many].view(np.int64)), "n": pa.array(counts[many])})

    counted = texts.mapInArrow(lean(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return bitmap_of(counted.where(F.col("n") >= FREQUENT).select("key"))


def _set_bitmap(values: np.ndarray) -> bytes:
    """Parities of the set's hashes in at least twice as many bits, a power of two."""
    bits = max(64, 1 << int(2 * len(values) - 1).bit_length())
    place = (word_hashes.mix(values) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _most_common(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """A bound on the overlap of two sets: each differing bit is a shingle of one of them."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def _links(common: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * common >= percent * (n_a + n_b - common)


def describe(texts: DataFrame) -> DataFrame:
    """``node, n, bits`` of every row: its class, set size and bitmap, beside its other columns (long) than ``text``."""
    others = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                values, ranges, _ = _sets(piece.column("text"))
                bits = [_set_bitmap(values[a:b]) if b > a else None for a, b in zip(ranges[:-1], ranges[1:])]
                yield _batch(
                    {
                        **{c: piece.column(c) for c in others},
                        "node": pa.array(_nodes(values, ranges)),
                        "n": pa.array(np.diff(ranges)),
                        "bits": pa.array(bits, pa.binary()),
                    }
                )

    return texts.mapInArrow(lean(run), ", ".join([*(f"{c} long" for c in others), "node long, n long, bits binary"]))


# --- Index and candidates ------------------------------------------------


def index_entries(texts: DataFrame, hot: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``key, node, size, double`` of every prefix; a negative size marks an entry that is only
    matched with documents of many frequent shingles. Under one key, two entries that are
    ``double`` (1) meet for two shingles, others for one."""
    broadcast = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                values, ranges, late = _sets(piece.column("text"), broadcast.value)
                nodes, sizes = _nodes(values, ranges), np.diff(ranges)
                first = _seen_once(nodes, seen) & (sizes > 1)
                prefix = np.minimum(sizes, sizes - -(-percent * sizes // 100) + 2)
                rank = np.arange(len(values)) - np.repeat(ranges[:-1], sizes)
                inside = (rank < np.repeat(prefix, sizes)) & np.repeat(first, sizes)
                row = np.repeat(np.arange(len(sizes)), sizes)
                rare = inside & ~late
                mixed = np.zeros(len(sizes), np.int64)
                mixed[row[inside & late]] = 1
                keys, owners, marks, doubles = [values[rare]], [row[rare]], [sizes[row[rare]]], [mixed[row[rare]]]
                frequent = np.flatnonzero(inside & late)
                starts = np.flatnonzero(np.diff(row[frequent], prepend=-1))
                for some in np.split(frequent, starts[1:]) if len(frequent) else []:
                    owner, tokens = row[some[0]], values[some]
                    few = len(tokens) <= MOST_PAIRED
                    if few:
                        i, j = np.triu_indices(len(tokens), 1)
                        keys.append(word_hashes.mix(tokens[i] + word_hashes.mix(tokens[j])))
                        owners.append(np.full(len(i), owner))
                        marks.append(np.full(len(i), sizes[owner]))
                        doubles.append(np.ones(len(i), np.int64))
                    keys.append(tokens)
                    owners.append(np.full(len(tokens), owner))
                    marks.append(np.full(len(tokens), -sizes[owner] if few else sizes[owner]))
                    doubles.append(np.zeros(len(tokens), np.int64))
                owners = np.concatenate(owners)
                yield _batch(
                    {
                        "key": pa.array(np.concatenate(keys).view(np.int64)),
                        "node": pa.array(nodes[owners]),
                        "size": pa.array(np.concatenate(marks).astype(np.int64)),
                        "double": pa.array(np.concatenate(doubles)),
                    }
                )

    return texts.mapInArrow(lean(run), "key long, node long, size long, double long")


def _pairs(nodes: np.ndarray, sizes: np.ndarray, doubles: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int):
    """Of the pairs i, j those that sizes and marks allow, the lesser node first, each with
    the number of shingles that they meet for."""
    n_i, n_j = np.abs(sizes[i]), np.abs(sizes[j])
    fits = 100 * np.minimum(n_i, n_j) >= percent * np.maximum(n_i, n_j)
    fits &= (sizes[i] > 0) | (sizes[j] > 0)
    i, j = i[fits], j[fits]
    a, b = np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])
    if not len(a):
        return a, b, np.zeros(0, np.int64)
    order = np.lexsort((b, a))
    a, b, met = a[order], b[order], (1 + doubles[i] * doubles[j])[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begin = np.flatnonzero(new)
    return a[begin], b[begin], np.add.reduceat(met, begin)


def list_candidates(entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``long_key, a, b, met``: pairs of classes and the shingles that they meet for in some of
    the short lists where ``long_key`` is null, else the members ``a`` of the long list of
    that key, with their mark in ``b``."""
    ordered = entries.repartition("key").sortWithinPartitions("key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        open_key = None  # of a long list that may go on in the next batch

        def lists(keys, nodes, sizes, doubles, last: bool):
            nonlocal open_key
            keep = np.ones(len(keys), bool)
            keep[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
            keys, nodes, sizes, doubles = keys[keep], nodes[keep], sizes[keep], doubles[keep]
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(keys)).astype(int)
            rest = [x[:0] for x in (keys, nodes, sizes, doubles)]
            if len(starts) and not last and ends[-1] - starts[-1] <= SHORT_LIST and keys[starts[-1]] != open_key:
                # The last list may go on in the next batch.
                rest = [x[starts[-1] :] for x in (keys, nodes, sizes, doubles)]
                starts, ends = starts[:-1], ends[:-1]
            goes_on = keys[starts] == open_key if open_key is not None else np.zeros(len(starts), bool)
            length = ends - starts
            long = goes_on | (length > SHORT_LIST)
            if len(starts) and long[-1]:
                open_key = int(keys[starts[-1]])
            i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for n in np.unique(length[~long & (length > 1)]).tolist():
                at = starts[~long & (length == n)]
                x, y = np.triu_indices(n, 1)
                i.append((at[:, None] + x).ravel())
                j.append((at[:, None] + y).ravel())
            a, b, met = _pairs(nodes, sizes, doubles, np.concatenate(i), np.concatenate(j), percent)
            member = np.repeat(long, length)
            member = np.concatenate([member, np.zeros(len(keys) - len(member), bool)])
            none = np.arange(len(a) + member.sum()) < len(a)
            result = {
                "long_key": pa.array(np.concatenate([np.zeros(len(a), np.int64), keys[member]]), mask=none),
                "a": pa.array(np.concatenate([a, nodes[member]])),
                "b": pa.array(np.concatenate([b, sizes[member]])),
                "met": pa.array(np.concatenate([met, np.zeros(member.sum(), np.int64)])),
            }
            return _batch(result), rest

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "node", "size", "double")]
            done, held = lists(*[np.concatenate([h, c]) for h, c in zip(held, columns)], last=False)
            yield done
        yield lists(*held, last=True)[0]

    return ordered.mapInArrow(lean(run), "long_key long, a long, b long, met long")


def hub_candidates(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs of each long list's hub with its members. ``members`` has ``long_key, mark, a, n, rank``."""
    hubs = members.groupBy("long_key").agg(F.max_by(F.struct("a", "mark", "n"), F.struct("rank", "a")).alias("hub"))
    met = members.join(hubs, "long_key").where(
        (F.col("a") != F.col("hub.a"))
        & ((F.col("mark") > 0) | (F.col("hub.mark") > 0))
        & (100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n"))
    )
    return met.select(F.least("a", "hub.a").alias("a"), F.greatest("a", "hub.a").alias("b")).distinct()


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow enough overlap."""
    side = lambda s: classes.select(
        F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")
    )
    joined = pairs.distinct().join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            keep = [
                _links(_most_common(p, q, m, n), m, n, percent)
                for p, q, m, n in zip(x["bits_a"], x["bits_b"], x["n_a"], x["n_b"])
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(lean(run), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, by the sets themselves."""
    pairs = stored(pairs, "pairs")
    wanted = bitmap_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    broadcast = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                values, ranges, _ = _sets(piece.column("text"))
                nodes = _nodes(values, ranges)
                asked = np.flatnonzero(has_bit(broadcast.value, nodes.view(np.uint64)) & (np.diff(ranges) > 0))
                asked = asked[_seen_once(nodes[asked], seen)]
                yield _batch(
                    {
                        "node": pa.array(nodes[asked]),
                        "hashes": pa.array([values[ranges[r] : ranges[r + 1]].tobytes() for r in asked], pa.binary()),
                    }
                )

    sets = texts.mapInArrow(lean(run), "node long, hashes binary")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(sets.join(needed, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")
    side = lambda s: sets.select(F.col("node").alias(s), F.col("hashes").alias(f"set_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(_links(common, len(p), len(q), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(lean(compare), "a long, b long")


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) brought down to a size: parities of halves add up."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


class _Block:
    """Members of a long list: nodes, marks, sizes, components, bitmaps and, if wanted, keys
    (all, and those under which they meet every member)."""

    def __init__(self, rows: list[tuple]):
        nodes, marks, sizes, roots, bits, *keys = zip(*rows) if rows else [()] * 5
        self.keys = [tuple(map(frozenset, x)) for x in zip(*keys)]
        self.nodes, self.marks, self.sizes, self.roots = (
            np.array(x, np.int64) for x in (nodes, marks, sizes, roots)
        )
        self.bits = [np.frombuffer(x, np.uint64) for x in bits]
        self.words = np.array([len(x) for x in self.bits], np.int64)
        self._at: dict[int, np.ndarray] = {}

    def at(self, words: int) -> np.ndarray:
        """All bitmaps of at least that many words, folded; smaller ones are zero."""
        if words not in self._at:
            table = np.zeros((len(self.bits), words), np.uint64)
            for k, x in enumerate(self.bits):
                if len(x) >= words:
                    table[k] = _folded(x, words)
            self._at[words] = table
        return self._at[words]

    def partners(self, other: "_Block", k: int, percent: int) -> np.ndarray:
        """Members of this block that may link to member ``k`` of another, of another component."""
        n = other.sizes[k]
        least = -(-percent * (n + self.sizes) // (100 + percent))
        fits = (self.roots != other.roots[k]) & ((self.marks > 0) | (other.marks[k] > 0))
        fits &= 100 * np.minimum(self.sizes, n) >= percent * np.maximum(self.sizes, n)
        for words in np.unique(np.minimum(self.words, other.words[k])).tolist():
            some = np.flatnonzero(fits & (np.minimum(self.words, other.words[k]) == words))
            differ = np.bitwise_count(self.at(words)[some] ^ _folded(other.bits[k], words)).sum(axis=1)
            fits[some] = (self.sizes[some] + n - differ.astype(np.int64)) // 2 >= least[some]
        return np.flatnonzero(fits)


def _between_components(members: DataFrame, roots: DataFrame, percent: int, many: bool = False) -> DataFrame:
    """Pairs of the long lists that lie in different components and whose bitmaps allow a link.

    ``members`` has ``a, lists, n, bits``, a row for each class. Long lists are cut into
    blocks, and each pair of blocks is a group of its own. Lists are dealt as narrow rows;
    bitmaps meet them last, for the one shuffle that brings a group together. If ``many``
    pairs are expected, members carry their keys too and a pair is given by the least key
    under which both may meet; else by all such keys, which are few rows to drop again.
    """
    keys = [F.col("lists.long_key").alias("keys"), F.filter("lists", lambda x: x["mark"] > 0)["long_key"].alias("open_keys")]
    keys = keys if many else []
    labelled = (
        members.select("a", "lists")
        .join(roots.select(F.col("node").alias("a"), "root"), "a", "left")
        .select(F.inline("lists"), "a", F.coalesce("root", "a").alias("root"))
    )
    split = (
        labelled.groupBy("long_key")
        .agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), (F.min("root") < F.max("root")).alias("split"))
        .where("split")
        .select("long_key", "blocks")
    )
    block = F.pmod(F.xxhash64("a"), F.col("blocks"))
    dealt = (
        labelled.join(split, "long_key")
        .withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")})
        .join(members.select("a", "n", "bits", *keys), "a")
        .select("long_key", "low", "high", "block", "a", "mark", "n", "root", "bits", *(["keys", "open_keys"] if many else []))
        .repartition("long_key", "low", "high")
        .sortWithinPartitions("long_key", "low", "high")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: int, low: int, high: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            first = _Block([r[1:] for r in rows if r[0] == low])
            second = first if low == high else _Block([r[1:] for r in rows if r[0] == high])
            for k in range(len(second.bits)):
                i = first.partners(second, k, percent)
                i = i[i < k] if low == high else i
                if many:
                    every, open_ = second.keys[k]
                    least = (min((every & first.keys[x][1]) | (open_ & first.keys[x][0])) for x in i.tolist())
                    i = i[np.fromiter(least, np.int64, len(i)) == key]
                if len(i):
                    x, y = first.nodes[i], second.nodes[k]
                    yield _batch({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

        open_, held = None, []
        for batch in batches:
            for key, low, high, *row in zip(*batch.to_pydict().values()):
                if (key, low, high) != open_:
                    if open_:
                        yield from pairs(*open_, held)
                    open_, held = (key, low, high), []
                held.append(row)
        if open_:
            yield from pairs(*open_, held)

    return dealt.mapInArrow(lean(run), "a long, b long").distinct()


# --- The join ------------------------------------------------------------


def similar_classes(texts: DataFrame, classes: DataFrame, percent: int = PERCENT, whole: bool = False) -> DataFrame:
    """Links ``a, b`` between classes; within a component they connect it, and are all only if ``whole``."""
    hot = frequent_shingles(texts)
    found = stored(list_candidates(index_entries(texts, hot, percent), percent), "lists")
    met = found.where("long_key IS NULL").groupBy("a", "b").agg(F.sum("met").alias("met"))
    candidates = met.where("met >= 2").select("a", "b")
    # One row for each class: its bitmap is not repeated for all of its lists.
    members = stored(
        found.where("long_key IS NOT NULL")
        .groupBy("a")
        .agg(F.collect_list(F.struct("long_key", F.col("b").alias("mark"))).alias("lists"))
        .join(classes.select(F.col("node").alias("a"), "n", "bits", "copies"), "a"),
        "members",
    )
    ranked = members.select(F.inline("lists"), "a", "n", F.struct("copies", F.size("lists") / F.col("n")).alias("rank"))
    candidates = candidates.unionByName(hub_candidates(ranked, percent))
    links = stored(_verified(_bounded(candidates, classes, percent), texts, percent), "links")
    if members.isEmpty():
        return links
    if whole:
        # Every class apart from every other: all pairs of the long lists.
        roots = classes.select("node", F.col("node").alias("root"))
        found = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = _between_components(members, roots, percent, many=True).join(found, ["a", "b"], "left_anti")
    else:
        rest = _between_components(members, connected_components(links), percent)
    return links.unionByName(stored(_verified(rest, texts, percent), "links"))


def _rows_and_classes(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored rows of ``describe``, and ``node, rep, copies, n, bits`` of their classes with shingles."""
    rows = stored(describe(texts), "classes")
    # Every doc_id of a class, but a class once: the copies are summed before the shuffle.
    classes = stored(
        rows.where("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("bits").alias("bits"),
        ),
        "classes",
    )
    return rows, classes


def join_documents(
    documents: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, classes = _rows_and_classes(texts)
    roots = connected_components(similar_classes(texts, classes, percent))
    rooted = classes.select("node", "rep").join(roots, "node", "left")
    linked = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least"))
    component = rooted.join(linked, "root", "left").select("node", F.coalesce("least", "rep").alias("component_id"))
    return (
        rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(component, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def link_counts(
    documents: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_links`` of every row: how many other rows it links to, copies included.

    All pairs of a group of near copies are looked at, so this grows with its square.
    """
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, classes = _rows_and_classes(texts)
    links = similar_classes(texts, classes, percent, whole=True)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(classes.select(F.col("node").alias("b"), "copies"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("copies").alias("linked"))
    )
    counts = classes.join(linked, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    return (
        rows.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(counts, "node", "left")
        .select("doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )


def _row_key(rows: DataFrame) -> Column:
    """A 64-bit hash of a row's values. It leaves maps out, which have no hash, and tells a null from no value."""
    names = [(F.col(f"`{f.name}`"), "map<" in f.dataType.simpleString()) for f in rows.schema.fields]
    return F.xxhash64(*(c for c, has_map in names if not has_map), *(c.isNull() for c, _ in names))


def first_of_each_component(documents: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, with all columns: that with the least id, a null being the
    last, and of several the one with the least hash. Rows without words all stay."""
    key = "row_key"
    while key in documents.columns:
        key += "_"
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = documents.withColumn(key, _row_key(documents))
    texts = keyed.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(key).alias("row_key"), "text")
    rows, classes = _rows_and_classes(texts)
    roots = connected_components(similar_classes(texts.select("doc_id", "text"), classes, percent))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "times")).alias("first")
    of_class = (
        rows.where("n > 0")
        .groupBy("node", "doc_id", "row_key")
        .agg(F.count("*").alias("times"))
        .groupBy("node")
        .agg(first)
        .join(roots, "node", "left")
    )
    chosen = stored(
        of_class.groupBy(F.coalesce("root", "node").alias("component"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row_key").alias(key), "first.times"),
        "chosen",
    )
    stay = keyed.where(worded).join(chosen.where("times = 1").select(key), key, "left_semi")
    repeated = chosen.where("times > 1").select(key)
    if not repeated.isEmpty():
        # Rows that are equal in all columns have no key of their own.
        stay = stay.unionByName(keyed.where(worded).join(repeated, key, "left_semi").dropDuplicates([key]))
    return stay.select(documents.columns).unionByName(documents.where(~worded))
