"""Benchmark decontamination: BM25 with block-max WAND, then overlap of question and answer.

The test items are the indexed side. An item is cut into segments of at most
``stride`` words; a document is read as passages of two strides that overlap by
one, so every segment that a document holds lies whole in some passage. Each
passage is a query. A term's impact on a segment is its BM25 weight as a share of
the segment's score with itself, so one threshold in (0, 1] means the same for
short and long items, and retrieval returns every segment at or above it.

Postings are in blocks of ``BLOCK`` segments with the greatest impact of each.
For all passages of a batch at once, block maxima are added up over their terms; a
passage whose sums stay below the threshold everywhere is done. For the rest a
cursor walk (weak AND) moves over the postings: it picks the first segment whose
terms' maxima could reach the threshold, skips the block if the block's maxima
cannot, and else scores it exactly.

A retrieved item counts when the part of the document around the passage holds
enough word trigrams of both its question and its answer; a part of one or two
words is looked for as it is, among the words or word pairs there. An item is split
after its last question mark, or in the middle if it has none.

Items of fewer than ``min_words`` words are too short for a threshold: those of
``verbatim_words`` and more match where the whole item stands word for word. With 1,
an item "Paris" takes every document that names the city, so the default is 3.

Only the benchmark is broadcast, in shards of at most ``shard_bytes`` of text,
each with a pass over the documents; documents are neither shuffled nor cut.

Words are compared without the punctuation at their edges, ASCII and typographic, and
without case: "(Paris)." is "paris". Marks that stand alone are no words.

Defined results: items and documents without text, and items of fewer words than
``verbatim_words``, match nothing; repeated items are reported each, repeated
documents too; ties do not matter, as all at or above the threshold are returned;
null ids stay null; an empty table gives no rows; extra columns are ignored; a very
long text is read whole, passage by passage.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import word_hashes
from tradewind.llm.worker_memory import kept

BLOCK = 4
_K1, _B = 1.2, 0.75
_END = 1 << 60


@dataclass(frozen=True)
class Parameters:
    stride: int = 48
    threshold: float = 0.5
    overlap: float = 0.5
    min_words: int = 5
    verbatim_words: int = 3
    shard_bytes: int = 8 << 20


def item_parts(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    at = text.rstrip().rfind("?", 0, len(text.rstrip()) - 1) + 1
    if not at:
        words = text.split()
        half = (len(words) + 1) // 2
        return " ".join(words[:half]), " ".join(words[half:])
    return text[:at], text[at:]


_IS_MARK = np.zeros(256, bool)
_IS_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def _marks(data: np.ndarray) -> np.ndarray:
    """Which bytes are punctuation: ASCII, general punctuation (E2 80 xx), « and », 、 and 。"""
    marks = _IS_MARK[data]
    for lead, following, lasts in ((0xE2, 0x80, range(0x80, 0xC0)), (0xE3, 0x80, (0x81, 0x82))):
        at = np.flatnonzero((data[:-2] == lead) & (data[1:-1] == following) & np.isin(data[2:], list(lasts)))
        marks[np.concatenate([at, at + 1, at + 2])] = True
    at = np.flatnonzero((data[:-1] == 0xC2) & np.isin(data[1:], [0xAB, 0xBB]))
    marks[np.concatenate([at, at + 1])] = True
    return marks


def bare_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without punctuation at their edges, and each row's range of them."""
    starts, ends, _, bounds = word_hashes.words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    place = np.arange(len(data))
    marks = _marks(data)
    after = np.minimum.accumulate(np.where(marks, len(data), place)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(marks, -1, place))
    first, last = after[starts], before[ends - 1] + 1
    stays = first < np.minimum(last, ends)
    sums = word_hashes.prefix_sums(word_hashes.LOWER[data])
    return word_hashes.range_hashes(sums, first[stays], last[stays]), np.concatenate([[0], np.cumsum(stays)])[bounds]


def _hashes(text: str) -> np.ndarray:
    return bare_words(*word_hashes.column_bytes(pa.array([text], pa.string())))[0]


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct runs of ``size`` words; none in a shorter sequence."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    return np.unique(word_hashes.shingles(hashes, np.array([0, len(hashes)]), size)[0])


def _part(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """Gram size of a question or an answer, and its grams."""
    size = max(1, min(3, len(hashes)))
    return size, _grams(hashes, size)


class Index:
    """An impact index over the segments of one shard of items."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], parameters: Parameters):
        self.items, self.parameters, stride = items, parameters, parameters.stride
        self.item_of, segments, self.parts, self.lengths = [], [], [], []
        verbatim: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for number, (_, text) in enumerate(items):
            words = _hashes(text)
            self.lengths.append(len(words))
            self.parts.append([_part(_hashes(p)) for p in item_parts(text)])
            if max(1, parameters.verbatim_words) <= len(words) < parameters.min_words:
                verbatim[len(words)][int(_grams(words, len(words))[0])].append(number)
            if len(words) >= parameters.min_words:
                pieces = math.ceil(len(words) / stride)
                for piece in np.array_split(words, pieces):
                    segments.append(piece)
                    self.item_of.append(number)
        # Items by their only gram, for each length.
        self.verbatim = {size: (np.array(sorted(x), np.uint64), x) for size, x in verbatim.items()}
        n = len(segments)
        self.vocabulary = np.unique(np.concatenate(segments)) if n else np.zeros(0, np.uint64)
        counts = [np.unique(np.searchsorted(self.vocabulary, s), return_counts=True) for s in segments]
        df = np.zeros(len(self.vocabulary))
        for terms, _ in counts:
            df[terms] += 1
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        mean = sum(map(len, segments)) / max(1, n)
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for number, (terms, tf) in enumerate(counts):
            norm = _K1 * (1 - _B + _B * len(segments[number]) / mean)
            weights = idf[terms] * tf * (_K1 + 1) / (tf + norm)
            for term, weight in zip(terms.tolist(), (weights / weights.sum()).tolist()):
                postings[term].append((number, weight))
        self.blocks = (n + BLOCK - 1) // BLOCK
        self.block_max = np.zeros((len(self.vocabulary), max(1, self.blocks)), np.float32)
        self.postings = [([s for s, _ in p], [w for _, w in p]) for _, p in sorted(postings.items())]
        for term, (at, weights) in enumerate(self.postings):
            np.maximum.at(self.block_max[term], np.array(at) // BLOCK, np.array(weights, np.float32))
        self.term_max = self.block_max.max(axis=1) if n else np.zeros(0, np.float32)

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """Segments whose impact sum over distinct ``terms`` reaches the threshold, by block-max WAND."""
        least = self.parameters.threshold - 1e-6
        lists = [(*self.postings[t], t, float(self.term_max[t])) for t in terms]
        at = [0] * len(lists)
        here = [x[0][0] for x in lists]
        order = list(range(len(lists)))
        out = []
        while True:
            order.sort(key=here.__getitem__)
            bound, pivot = 0.0, _END
            for k in order:
                if here[k] == _END:
                    break
                bound += lists[k][3]
                if bound >= least:
                    pivot = here[k]
                    break
            if pivot == _END:
                return out
            block = pivot // BLOCK
            involved = [k for k in order if here[k] <= pivot]
            if sum(self.block_max[lists[k][2], block] for k in involved) < least:
                # No segment up to the block's end, or to the next list's segment, can reach it.
                following = [here[k] for k in order if here[k] > pivot]
                target = min([(block + 1) * BLOCK, *following])
            elif here[order[0]] == pivot:
                score = sum(lists[k][1][at[k]] for k in involved)
                if score >= least:
                    out.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for k in involved:
                places = lists[k][0]
                i = at[k]
                while i < len(places) and places[i] < target:
                    i += 1
                at[k] = i
                here[k] = places[i] if i < len(places) else _END

    def search(self, hashes: np.ndarray, bounds: np.ndarray):
        """``(row, item, score, question, answer, passages, first word)`` of all rows' leaks."""
        if not len(hashes):
            return
        found: dict[tuple[int, int], list] = {}
        if self.blocks:
            self._search_segments(hashes, bounds, found)
        self._search_verbatim(hashes, bounds, found)
        for (row, item), (score, question, answer, numbers, start) in sorted(found.items()):
            yield row, item, score, question, answer, len(numbers), start

    def _passages(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's number of passages, and the number of its first.

        Passage p of a row has words p*stride to p*stride+size; the last one reaches the row's end.
        """
        stride, size = self.parameters.stride, 2 * self.parameters.stride
        counts = np.diff(bounds)
        passages = np.where(counts > 0, np.maximum(1, -(-(counts - size) // stride) + 1), 0)
        return passages, np.concatenate([[0], np.cumsum(passages)])

    def _search_verbatim(self, hashes: np.ndarray, bounds: np.ndarray, found: dict[tuple[int, int], list]) -> None:
        stride = self.parameters.stride
        passages, _ = self._passages(bounds)
        for size, (wanted, items) in self.verbatim.items():
            grams, ranges = word_hashes.shingles(hashes, bounds, size)
            for at in np.flatnonzero(np.isin(grams, wanted)).tolist():
                row = int(np.searchsorted(ranges, at, side="right")) - 1
                place = at - int(ranges[row])
                last = min(place // stride, int(passages[row]) - 1)
                # The passages that hold the whole item.
                numbers = [p for p in (last - 1, last) if p >= 0 and place + size <= (p + 2) * stride]
                for item in items[int(grams[at])]:
                    old = found.setdefault((row, item), [1.0, 1.0, 1.0, set(), numbers[0] * stride])
                    old[3].update(numbers)

    def _search_segments(self, hashes: np.ndarray, bounds: np.ndarray, found: dict[tuple[int, int], list]) -> None:
        stride, size = self.parameters.stride, 2 * self.parameters.stride
        term = np.searchsorted(self.vocabulary, hashes)
        term[term == len(self.vocabulary)] = 0
        known = self.vocabulary[term] == hashes
        counts = np.diff(bounds)
        passages, first = self._passages(bounds)
        row_of_word = np.repeat(np.arange(len(counts)), counts)[known]
        place = np.arange(len(hashes))[known] - bounds[row_of_word]
        ids = term[known].astype(np.int64)
        step = place // stride
        keys = []
        for back in (0, 1):
            p = step - back
            fits = (p >= 0) & (p < passages[row_of_word])
            keys.append((first[row_of_word[fits]] + p[fits]) * len(self.vocabulary) + ids[fits])
        keys = np.unique(np.concatenate(keys))
        if not len(keys):
            return
        passage, ids = np.divmod(keys, len(self.vocabulary))
        begins = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        ends = np.append(begins[1:], len(keys))
        alive = []
        for lo in range(0, len(begins), 512):
            some = begins[lo : lo + 512]
            stop = ends[min(lo + 511, len(begins) - 1)]
            sums = np.add.reduceat(self.block_max[ids[some[0] : stop]], some - some[0], axis=0)
            alive.append(lo + np.flatnonzero((sums >= self.parameters.threshold - 1e-4).any(axis=1)))
        for a in np.concatenate(alive).tolist():
            number = int(passage[begins[a]])
            for segment, score in self.retrieve(ids[begins[a] : ends[a]].tolist()):
                row = int(np.searchsorted(first, number, side="right")) - 1
                item = self.item_of[segment]
                start = (number - int(first[row])) * stride
                lo = int(bounds[row]) + max(0, start - self.lengths[item])
                hi = min(int(bounds[row + 1]), int(bounds[row]) + start + size + self.lengths[item])
                near = {n: _grams(hashes[lo:hi], n) for n in {n for n, _ in self.parts[item]}}
                question, answer = (self._share(part, near[n]) for n, part in self.parts[item])
                if question >= self.parameters.overlap and answer >= self.parameters.overlap:
                    old = found.setdefault((row, item), [0.0, 0.0, 0.0, set(), start])
                    old[0], old[1], old[2] = max(old[0], score), max(old[1], question), max(old[2], answer)
                    old[3].add(number)

    @staticmethod
    def _share(part: np.ndarray, near: np.ndarray) -> float:
        return float(np.isin(part, near).mean()) if len(part) else 1.0


def _index(items: tuple[tuple[int | None, str], ...], parameters: Parameters) -> Index:
    return kept(("items", items, parameters), lambda: Index(items, parameters))


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    parameters: Parameters = Parameters(),
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row for each document and each test item that it contains."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
        "n_passages int, first_word long"
    )

    def one(items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(items, parameters)
            for batch in batches:
                for piece in word_hashes.slices(batch, "text"):
                    hashes, bounds = bare_words(*word_hashes.column_bytes(piece.column("text")))
                    found = list(index.search(hashes, bounds))
                    if found:
                        ids = piece.column("doc_id").to_pylist()
                        out = [(ids[r], items[i][0], *rest) for r, i, *rest in found]
                        types = [pa.int64()] * 2 + [pa.float64()] * 3 + [pa.int32(), pa.int64()]
                        names = [c.split()[0] for c in schema.split(", ")]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names
                        )

        return rows.mapInArrow(run, schema)

    results = None
    for items in benchmark_shards(benchmark, parameters, item_id, item_text):
        found = one(items)
        results = found if results is None else results.unionByName(found)
    return results


def benchmark_shards(
    benchmark: DataFrame, parameters: Parameters = Parameters(), item_id: str = "item_id", item_text: str = "text"
) -> list[tuple[tuple[int | None, str], ...]]:
    """The test items in shards of bounded size, each small enough to go with a task."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-size // parameters.shard_bytes))
    shards = []
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k) if count > 1 else items
        shards.append(tuple((r["id"], r["text"]) for r in part.orderBy("id", "text").collect()))
    return shards


def without_leaks(documents: DataFrame, benchmark: DataFrame, parameters: Parameters = Parameters()) -> DataFrame:
    """The documents that contain no test item, with all their columns."""
    kept = documents
    for items in benchmark_shards(benchmark, parameters):
        kept = _without(kept, items, parameters)
    return kept


def _without(documents: DataFrame, items, parameters: Parameters) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(items, parameters)
        for batch in batches:
            for piece in word_hashes.slices(batch, "text"):
                hashes, bounds = bare_words(*word_hashes.column_bytes(piece.column("text")))
                clean = np.ones(piece.num_rows, bool)
                clean[[r for r, *_ in index.search(hashes, bounds)]] = False
                yield piece.filter(pa.array(clean))

    return documents.mapInArrow(run, documents.schema)
