"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on what is
particular to toxic text: windows holding a byte n-gram that is ``particular``
times as frequent among toxic documents. A window is a word with a space on both
sides. Its compressed length under the ordinary dictionary less that under the
toxic one is its distance; a window that repeats toxic text is shorter under the
second. A document is described by how many of its windows reach each of several
distances, and a logistic fit on labelled documents kept out of the dictionaries
calibrates these thresholds to a probability.

Only training data is collected, and it is bounded by parameters: at most
``sample_toxic`` and ``sample_ordinary`` labelled documents, those with the
smallest hash of their id, each of at most ``sample_bytes`` bytes. The labels are
counted whole for the class shares. Scoring reads every document once, whole, and
shuffles nothing; tasks keep the distances of words they have met in a table of
bounded size.

Defined results: a null or empty text has no windows and gets the score of an
empty document; without labels of both classes the score is the share of toxic
labels (0 if there are none); a null label is no label, of repeated labels of an
id any toxic one counts; repeated rows are scored each; a null id stays null; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import crc_remainder
from tradewind.llm.worker_memory import kept

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# zstandard looks for no match that starts in a window's last bytes, so windows end in padding.
_PADDING = b"\0" * 10
_GRAM = 5
DISTANCES = tuple(range(1, 9))
DICTIONARY_BYTES = 8192
TABLE_SIZE = 250_000


@dataclass(frozen=True)
class Parameters:
    sample_toxic: int = 2500
    sample_ordinary: int = 5000
    sample_bytes: int = 32768
    particular: float = 20.0
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """The dictionaries' bytes and the calibration; small enough to go with the task."""

    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()
    prior: float = 0.0


def windows(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "replace").lower())


def _grams(window: bytes) -> set[bytes]:
    padded = b" " + window + b" "
    return {padded[i : i + _GRAM] for i in range(len(padded) - _GRAM + 1)}


def _train(samples: list[bytes]) -> bytes:
    """A dictionary of the largest size that the samples allow."""
    size = DICTIONARY_BYTES
    while size >= 256 and sum(map(len, samples)) >= 2 * size:
        try:
            return zstandard.train_dictionary(size, samples, k=48, d=6, level=3).as_bytes()
        except zstandard.ZstdError:
            size //= 2
    # Too little to train on: the distinct windows themselves serve as the dictionary.
    return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]


class Distances:
    """Distances of words under a pair of dictionaries, with a bounded table."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = [self._compressor(b) for b in (ordinary, toxic)]
        self.table: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(
            window_log=10,
            hash_log=10,
            chain_log=10,
            search_log=4,
            min_match=4,
            target_length=8,
            strategy=zstandard.STRATEGY_LAZY,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
        )
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)

    def of(self, window: bytes) -> int:
        known = self.table.get(window)
        if known is None:
            padded = b" " + window + b" " + _PADDING
            ordinary, toxic = (len(c.compress(padded)) for c in self.compressors)
            known = ordinary - toxic
            if len(self.table) < TABLE_SIZE:
                self.table[window] = known
        return known

    def features(self, text: str) -> list[float]:
        distances = np.fromiter(map(self.of, windows(text)), np.int64)
        reached = [np.count_nonzero(distances >= d) for d in DISTANCES]
        return [1.0, float(np.log1p(len(distances))), float(max(distances, default=0)), *np.log1p(reached).tolist()]


def _distances(ordinary: bytes, toxic: bytes) -> Distances:
    return kept(("distances", ordinary, toxic), lambda: Distances(ordinary, toxic))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by damped Newton steps; the first column is the constant."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * b * b).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-4 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return beta


def fit(
    documents: DataFrame,
    labels: DataFrame,
    parameters: Parameters = Parameters(),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """A model from labelled documents; ``labels`` holds the rows that may be learnt from."""
    per_id = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg((F.max(F.col(label).cast("int")) > 0).alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in per_id.groupBy("toxic").count().collect()}
    prior = totals.get(True, 0) / max(1, sum(totals.values()))
    picked: dict[int, bool] = {}
    for is_toxic, most in ((True, parameters.sample_toxic), (False, parameters.sample_ordinary)):
        of_class = per_id.where(F.col("toxic") == is_toxic)
        for r in of_class.orderBy(F.xxhash64("id"), "id").select("id").limit(most).collect():
            picked[r["id"]] = is_toxic
    if len(set(picked.values())) < 2:
        return Model(prior=prior)
    sample = (
        documents.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .where(F.col("id").isin(list(picked)) & (F.octet_length("text") <= parameters.sample_bytes))
        .dropDuplicates()
        .orderBy(F.xxhash64("id", "text"), "id", "text")
        .limit(parameters.sample_toxic + parameters.sample_ordinary)
        .collect()
    )
    # Two thirds train the dictionaries, the rest calibrates them.
    trains: dict[bool, list[str]] = {True: [], False: []}
    calibrates: list[tuple[str, bool]] = []
    for number, r in enumerate(sample):
        if number % 3 < 2:
            trains[picked[r["id"]]].append(r["text"])
        else:
            calibrates.append((r["text"], picked[r["id"]]))
    if not trains[True] or not trains[False] or len({y for _, y in calibrates}) < 2:
        return Model(prior=prior)

    counts = {}
    for is_toxic, texts in trains.items():
        counts[is_toxic] = Counter()
        for t in texts:
            counts[is_toxic].update({g for w in set(windows(t)) for g in _grams(w)})
    n_toxic, n_ordinary = len(trains[True]), len(trains[False])
    least = max(3, n_toxic // 250)
    particular = {
        g
        for g, c in counts[True].items()
        if c >= least and c / n_toxic >= parameters.particular * (counts[False].get(g, 0) + 0.5) / n_ordinary
    }
    toxic_windows = [b" " + w + b" " for t in trains[True] for w in windows(t) if not particular.isdisjoint(_grams(w))]
    ordinary_windows = [b" " + w + b" " for t in trains[False] for w in windows(t)]
    if not toxic_windows or not ordinary_windows:
        return Model(prior=prior)
    # The trainer needs no more ordinary windows than some hundred times the dictionary.
    step = max(1, len(ordinary_windows) // 400_000)
    ordinary, toxic = _train(ordinary_windows[::step]), _train(toxic_windows)

    distances = Distances(ordinary, toxic)
    x = np.array([distances.features(t) for t, _ in calibrates])
    y = np.array([float(y) for _, y in calibrates])
    weight = np.where(y > 0, totals[True] / max(1, y.sum()), totals[False] / max(1, (1 - y).sum()))
    beta = _logistic(x, y, weight / weight.mean())
    return Model(ordinary, toxic, tuple(beta.tolist()), prior)


def _scores(column: pa.Array, model: Model) -> np.ndarray:
    texts = column.to_pylist()
    if not model.weights:
        return np.full(len(texts), model.prior)
    distances = _distances(model.ordinary, model.toxic)
    z = np.array([np.dot(distances.features(t or ""), model.weights) for t in texts], np.float64)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(
    documents: DataFrame, model: Model, parameters: Parameters = Parameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``documents`` with ``score`` (0 to 1) and ``predicted`` (0 or 1)."""
    threshold = parameters.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column(text), model)
            names = [n for n in batch.schema.names if n not in ("score", "predicted")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[*names, "score", "predicted"],
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name not in ("score", "predicted")]
    return documents.mapInArrow(run, ", ".join([*kept, "score double", "predicted int"]))


def without_toxic(
    documents: DataFrame, model: Model, parameters: Parameters = Parameters(), text: str = "text"
) -> DataFrame:
    """The documents scored below the threshold, with all columns as they are."""
    threshold = parameters.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(text), model) < threshold))

    return documents.mapInArrow(run, documents.schema)


def learnable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The label rows that the contract lets a model learn from."""
    return labels.where(crc_remainder(doc_id, 4) != 2)
