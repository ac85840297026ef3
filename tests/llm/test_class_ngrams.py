from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import MEDIUM
from tests.llm.conftest import words_of
from tradewind.llm import word_hashes
from tradewind.llm.class_ngrams import Parameters, exchange_clusters, score_documents, train, word_counts
from tradewind.llm.tables import read


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def check(rows, got):
    tokens = [words_of(t) + [None] for _, t in rows]
    counts = collections.Counter(w for (d, _), ws in zip(rows, tokens) if not held_out(d) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (
            (
                d,
                held_out(d),
                len(ws),
                sum(counts[w] > 0 for w in ws),
                total,
                round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 6),
            )
            for (d, _), ws in zip(rows, tokens)
        ),
        key=str,
    )
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in got), key=str) == want


def test_base_counts_and_better_than_base(spark):
    documents = read(spark, MEDIUM, "documents")
    got = score_documents(documents).collect()
    check([(r["doc_id"], r["text"]) for r in documents.collect()], got)
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    assert np.mean([r["score"] > r["base_score"] for r in unseen]) > 0.95


@pytest.mark.parametrize("ids", [range(12), [i for i in range(60) if held_out(i)]])
def test_nulls_repeats_and_nothing_to_learn(documents, ids):
    texts = ["a b A", None, "", "a b A", "é \x0b x", "word " * 30]
    rows = [(i, texts[k % 6]) for k, i in enumerate(ids)]
    if 0 in ids:
        rows += [(None, "a b"), (0, "a b A")]
    check(rows, score_documents(documents(rows)).collect())


def test_empty_table(documents):
    assert score_documents(documents([(1, "x")]).where("false")).collect() == []


def likelihood(pairs, of, classes):
    member = np.eye(classes)[of]
    table = member.T @ pairs @ member
    entropy = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return entropy(table) - entropy(table.sum(axis=0)) - entropy(table.sum(axis=1))


def test_exchange_leaves_no_move_that_helps():
    rng = np.random.default_rng(1)
    pairs = np.zeros((21, 21))
    for _ in range(4000):
        a, b = rng.integers(0, 10), rng.integers(10, 20)
        pairs[a, b] += 1
        pairs[b, rng.integers(0, 10)] += 1
    pairs += rng.integers(0, 30, (21, 21))
    of = exchange_clusters(pairs, 5, 50)
    assert of[20] == 4 and (of[:20] < 4).all()
    best = likelihood(pairs, of, 5)
    for unit in range(20):
        for target in range(4):
            moved = of.copy()
            moved[unit] = target
            assert likelihood(pairs, moved, 5) <= best + 1e-6


def test_exchange_parts_words_that_alternate():
    pairs = np.zeros((9, 9))
    pairs[:4, 4:8] = pairs[4:8, :4] = 100
    pairs[8, 0] = pairs[5, 8] = 1
    of = exchange_clusters(pairs, 3, 20)
    assert len(set(of[:4])) == 1 and len(set(of[4:8])) == 1 and of[0] != of[4] and of[8] == 2


def test_rare_words_get_classes_from_their_neighbours(documents):
    """Words outside the core that share an ending, and so a pool, are told apart by what surrounds them."""
    nouns, verbs = [f"n{i}xx" for i in range(30)], [f"v{i}xx" for i in range(30)]
    rng = np.random.default_rng(1)
    either = lambda common, rare: common if rng.random() < 0.5 else rare[rng.integers(30)]
    rows = [(i, f"the {either('dog', nouns)} did {either('run', verbs)} end") for i in range(400)]
    texts = documents(rows).select("text")
    parameters = Parameters(core=5, pools=4, classes=10)
    model, words = train(texts, word_counts(texts, parameters), parameters)
    of = {r["word"]: r["class"] for r in words.collect()}
    assert sum(c is None for c in of.values()) == 5

    def classes(some):
        hashes = word_hashes.words(*word_hashes.column_bytes(pa.array(some)))[2].view(np.int64).tolist()
        return {of[h] for h in hashes if h in of}

    assert len(classes(nouns)) == len(classes(verbs)) == 1 and classes(nouns) != classes(verbs)
    assert model.tokens.sum() == model.total == 400 * 6 and model.words.sum() == model.distinct == len(of) + 1
