"""Maximal periodic runs of words, by branching squares in an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no neighbouring
word extends; runs of at least ``least_words`` words and ``least_exponent`` periods
are reported. Collapsing a text keeps a run's first q words.

Stretches. Every word of a run with exponent e occurs e times in it. So a text is cut
at the words that occur fewer times in their stretch, and stretches that are too
short go, until nothing changes. Ordinary prose vanishes here, a few numpy passes
over a megabyte of texts at a time; what is left goes on. No run is lost.

Suffix array. The suffixes of all stretches of a piece are sorted by prefix doubling.
Words of different stretches count as different, so that only suffixes of one stretch
share a prefix. Ranks of every doubling are kept: they give the common prefix of neighbours, and compare any two
substrings from then on. Prefixes are told apart up to the greatest period that a
stretch has room for; the order beyond that plays no part.

Branching squares. A scan with a stack finds, for every common prefix of two
neighbours, the interval of suffixes that share it: a node of the interval tree as two
numbers, its suffixes left and right of that place. An interval with several children is
a chain of such nodes. For each suffix i of the smaller side and depth d, i + d and
i - d are looked up in the inverse suffix array: one that lies in the other side makes a
square of period d that the next word does not extend. Every pair of children is
asked from its smaller side only, n log n look-ups in all.

Runs. A square is rotated to the left as far as its words agree, by comparing ranks
of doubled lengths downwards. Rotations of one square and squares of multiples of a
period end in the same stretch of words, which the least of their periods names.

Words are compared by 64-bit hashes of their bytes. The ranks take about 100 bytes a
word of the longest text in a piece; only words that recur often count.

Defined results: a null text has no words and no runs, like an empty one; two runs
may overlap, and a word goes if any run drops it; equal rows get equal results,
whatever their doc_id; an empty table gives no rows; other columns are kept, and
``runs`` and ``collapsed`` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm import word_hashes
from tradewind.llm.tables import crc_remainder
from tradewind.llm.worker_memory import lean

LEAST_WORDS = 6
LEAST_EXPONENT = 4
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ADDED = ("runs", "collapsed")
_LOOKUPS = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# --- Words and stretches -------------------------------------------------


def split_words(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all words as they are written, and each row's range of words."""
    inside = ~_IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    last = np.ones(len(data), bool)
    last[:-1] = ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(inside & last) + 1, np.searchsorted(starts, offsets)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the keys, in their order, and how often each number occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    numbers = np.empty(len(keys), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers, np.bincount(numbers)


def _words_in(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Hashes of the words that differ between groups."""
    return word_hashes.mix(words ^ word_hashes.mix(group.astype(np.uint64) + np.uint64(1)))


def frequent_stretches(words: np.ndarray, group: np.ndarray, least: int, times: int):
    """Places and stretch numbers of the words that may lie in runs.

    ``group`` does not fall from word to word. Words that occur fewer than ``times`` in
    their stretch cut it; stretches of fewer than ``least`` words go.
    """
    at = np.arange(len(words))
    while len(at):
        number, count = _numbered(_words_in(words[at], group))
        keep = count[number] >= times
        kept, of = at[keep], group[keep]
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (of[1:] != of[:-1])
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch)[stretch] >= least if len(kept) else np.zeros(0, bool)
        settled = keep.all() and long.all()
        at, group = kept[long], stretch[long]
        if settled:
            break
    return at, group


# --- Enhanced suffix array -----------------------------------------------


def ranked_prefixes(number: np.ndarray, group: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of the substrings of 1, 2, 4 … words at every place, until ``depth`` words are told apart."""
    n = len(number)
    ranks, size = [number], 1
    while size < depth:
        # Behind a stretch's end lies nothing, which comes before everything.
        following = np.zeros(n, np.int64)
        following[: n - size] = np.where(group[size:] == group[: n - size], ranks[-1][size:] + 1, 0)
        longer, count = _numbered(ranks[-1] * (n + 1) + following)
        ranks.append(longer)
        size *= 2
        if len(count) == n:
            break
    return ranks


def common_prefixes(ranks: list[np.ndarray], group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order``; 0 for the first.

    Beyond twice the longest substring that has ranks, it is cut.
    """
    n = len(order)
    a, b = order[:-1], order[1:]
    shared = np.zeros(max(n - 1, 0), np.int64)
    for k in reversed(range(len(ranks))):
        i, j = a + shared, b + shared
        # Equal ranks are equal words of one stretch; nothing behind its end is.
        inside = np.maximum(i, j) < n
        inside[inside] = (group[i[inside]] == group[a[inside]]) & (group[j[inside]] == group[a[inside]])
        inside[inside] = ranks[k][i[inside]] == ranks[k][j[inside]]
        shared[inside] += 1 << k
    return np.concatenate([[0], shared])


def prefix_nodes(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last suffix of the interval around each common prefix, by a scan with a stack.

    Of equal prefixes the earlier one holds the later, so a place splits its interval
    in two and an interval of several children is a chain.
    """
    values = common.tolist()
    n = len(values)
    first, last = [0] * n, [n - 1] * n
    stack: list[int] = []
    for i in range(1, n):
        value, low = values[i], i - 1
        while stack and values[stack[-1]] > value:
            top = stack.pop()
            last[top] = i - 1
            low = first[top]
        if stack and values[stack[-1]] == value:
            # The earlier one's right side starts at its own place.
            low = stack[-1]
        first[i] = low
        stack.append(i)
    return np.array(first, np.int64), np.array(last, np.int64)


def _left_agreement(ranks: list[np.ndarray], group: np.ndarray, i: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How many words before ``i`` equal those one period later."""
    reach = np.zeros(len(i), np.int64)

    def step(k: int) -> np.ndarray:
        a = i - reach - (1 << k)
        inside = a >= 0
        inside[inside] = group[a[inside]] == group[i[inside]]
        inside[inside] = ranks[k][a[inside]] == ranks[k][(a + period)[inside]]
        reach[inside] += 1 << k
        return inside

    top = len(ranks) - 1
    while step(top).any():
        pass
    for k in reversed(range(top)):
        step(k)
    return reach


def branching_squares(ranks: list[np.ndarray], group: np.ndarray, most_period: np.ndarray):
    """Start and period of every square that the word behind it does not extend."""
    n = len(group)
    order = np.lexsort((np.arange(n), ranks[-1]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    common = common_prefixes(ranks, group, order)
    first, last = prefix_nodes(common)
    node = np.arange(n)
    asked = np.flatnonzero((common > 0) & (common <= most_period[group[order]]))
    left_smaller = node - first <= last - node + 1
    begin, end = np.where(left_smaller, first, node), np.where(left_smaller, node, last + 1)
    other_begin, other_end = np.where(left_smaller, node, first), np.where(left_smaller, last + 1, node)
    sizes = (end - begin)[asked]
    found = []
    total = np.cumsum(sizes)
    cuts = np.searchsorted(total, np.arange(_LOOKUPS, int(total[-1]) if len(total) else 0, _LOOKUPS))
    for some in np.split(asked, np.unique(cuts)):
        size = (end - begin)[some]
        of = np.repeat(some, size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[of]
        i, depth = order[at], common[of]
        for sign in (1, -1):
            j = i + sign * depth
            inside = (j >= 0) & (j < n)
            inside[inside] = group[j[inside]] == group[i[inside]]
            rank = place[np.where(inside, j, 0)]
            inside &= (rank >= other_begin[of]) & (rank < other_end[of])
            found.append((np.minimum(i, j)[inside], depth[inside]))
    starts, periods = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return starts, periods


def find_runs(words: np.ndarray, bounds: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT):
    """Row, start, length and period of every run of a piece, by row, start and period.

    ``words`` are hashes, ``bounds`` each row's range of them.
    """
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, group = frequent_stretches(words, row, least_words, least_exponent)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none
    number, _ = _numbered(_words_in(words[at], group))
    most_period = np.bincount(group) // least_exponent
    ranks = ranked_prefixes(number, group, int(most_period.max()) + 1)
    i, period = branching_squares(ranks, group, most_period)
    begin = i - _left_agreement(ranks, group, i, period)
    end = i + 2 * period
    length = end - begin
    enough = (length >= least_words) & (length >= least_exponent * period)
    begin, length, period = begin[enough], length[enough], period[enough]
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, period = begin[new], length[new], period[new]
    start = at[begin]
    of = row[start]
    order = np.lexsort((period, start))
    return of[order], (start - bounds[of])[order], length[order], period[order]


# --- Rows ----------------------------------------------------------------


def _kept(n: int, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray, bounds: np.ndarray):
    """Which words no run drops."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, bounds[row] + start + period, 1)
    np.add.at(change, bounds[row] + start + length, -1)
    return np.cumsum(change)[:n] == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each row's kept words with one space between them."""
    sizes = (ends - starts)[keep] + 1
    kept_bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
    to = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(to[-1]) - np.repeat(to[:-1] - starts[keep], sizes)
    spaced = data[np.minimum(source, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    spaced[to[1:] - 1] = 0x20
    text = spaced.tobytes()
    cuts = to[kept_bounds].tolist()
    return pa.array([text[a : max(a, b - 1)].decode() for a, b in zip(cuts, cuts[1:])], pa.string())


def collapse_runs(
    documents: DataFrame,
    least_words: int = LEAST_WORDS,
    least_exponent: int = LEAST_EXPONENT,
    text: str = "text",
) -> DataFrame:
    """All columns, with ``runs`` (start, length, period; by start, then period) and the ``collapsed`` text."""
    own = [f for f in documents.schema.fields if f.name not in _ADDED]
    names = [f.name for f in own]
    run_type = pa.struct([(n, pa.int64()) for n in RUN.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_hashes.slices(batch, text):
                data, offsets = word_hashes.column_bytes(piece.column(text))
                starts, ends, bounds = split_words(data, offsets)
                hashes = word_hashes.range_hashes(word_hashes.prefix_sums(data), starts, ends)
                row, start, length, period = find_runs(hashes, bounds, least_words, least_exponent)
                keep = _kept(len(starts), row, start, length, period, bounds)
                items = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(run_type))
                per_row = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(per_row), items)
                yield pa.RecordBatch.from_arrays(
                    [*map(piece.column, names), runs, _joined(data, starts, ends, bounds, keep)],
                    names=[*names, *_ADDED],
                )

    added = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return documents.mapInArrow(lean(run), T.StructType([*own, *added]))


def with_periods(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``; a tenth of the documents, picked by a hash of their id, repeat some of their words to the end.

    With h the crc32 of the id, g = h div 10 and n words, those with h % 10 = 0 have each word i from a = g % n on
    replaced by word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). A null id counts as an empty one.
    """
    h = crc_remainder(doc_id, 1 << 32)
    words = F.when(
        h % 10 == 0,
        F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)),
    )
    split = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.floor(h / 10).alias("g"), words.alias("words"),
    ).withColumn("n", F.size("words"))
    placed = split.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.nullif("n", F.lit(0))).cast("int")))
    period = placed.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), F.col("n") - F.col("a"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return period.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def _longest(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first."""
    greater = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, 0), lambda best, x: F.when(greater(x, best), x).otherwise(best))


def digests(collapsed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The report of :func:`collapse_runs`' rows: their runs, the one of greatest exponent, and digests."""
    best = collapsed.select(
        F.col(doc_id).cast("long").alias("doc_id"), "runs", "collapsed", _longest(F.col("runs")).alias("best")
    )
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias(
            "runs_sha256"
        ),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
