from __future__ import annotations

import math
import random
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import MEDIUM
from tradewind.llm import word_hashes
from tradewind.llm.compression_toxicity import Parameters as ToxicityParameters
from tradewind.llm.compression_toxicity import fit, learnable, score, without_toxic
from tradewind.llm.decontaminate import Index, Parameters, _hashes, bare_words, item_parts, leaks, without_leaks
from tradewind.llm.tables import crc_remainder, read

# --- Toxicity ------------------------------------------------------------


def corpus(count=900, seed=1):
    rng = random.Random(seed)
    syllables = ["the", "on", "er", "sh", "ti", "an", "re", "in", "ou", "wh"]
    bad = ["zorkblat", "quvvix", "mumpfle"]
    rows, labels = [], []
    for i in range(count):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, documents):
    rows, labels = corpus()
    frame, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(frame, learnable(marks))
    scored = score(frame, model).join(marks, "doc_id").where(crc_remainder("doc_id", 4) == 2).collect()
    assert len(scored) > 100
    assert np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)


def test_labels_held_out_are_not_learnt(spark):
    marks = read(spark, MEDIUM, "labels")
    assert learnable(marks).where(crc_remainder("doc_id", 4) == 2).count() == 0


def test_odd_rows_and_labels(spark):
    rows, labels = corpus(200)
    odd = [(900, None), (901, ""), (None, "the on"), (5, rows[5][1]), (902, "the " * 30000)]
    frame = spark.createDataFrame([(*r, "kept", 9.0) for r in rows + odd], "doc_id long, text string, toxic string, score double")
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (900, 0), (7, 0)], "doc_id long, toxic int")
    got = score(frame, fit(frame, marks)).collect()
    assert len(got) == len(rows + odd) and {r["toxic"] for r in got} == {"kept"}
    stay = without_toxic(frame, fit(frame, marks))
    assert stay.columns == frame.columns and {r["score"] for r in stay.collect()} == {9.0}
    assert stay.count() == sum(r["predicted"] == 0 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (900, 901)}
    assert len(empty) == 1 and empty.pop() < 0.3
    assert score(frame.where("false"), fit(frame, marks)).collect() == []


@pytest.mark.parametrize("labels, prior", [([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_both_classes(spark, documents, labels, prior):
    frame = documents([(1, "a b"), (2, None)])
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r["score"] for r in score(frame, fit(frame, marks)).collect()} == {prior}


# --- Benchmark leaks -----------------------------------------------------


def test_weak_and_equals_exhaustive_scores():
    rng = random.Random(1)
    items = tuple((i, " ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(rng.randint(5, 90)))) for i in range(60))
    index = Index(items, Parameters())
    impacts = np.zeros((len(index.vocabulary), len(index.item_of)))
    for term, (at, weights) in enumerate(index.postings):
        impacts[term, at] = weights
    assert np.allclose(impacts.sum(axis=0), 1)
    for _ in range(300):
        segment = rng.randrange(len(index.item_of))
        own = np.flatnonzero(impacts[:, segment]).tolist()
        terms = sorted(set(rng.sample(own, rng.randint(1, len(own))) + rng.sample(range(len(index.vocabulary)), 25)))
        scores = impacts[terms].sum(axis=0)
        got = dict(index.retrieve(terms))
        assert sorted(got) == np.flatnonzero(scores >= 0.5 - 1e-6).tolist()
        assert all(abs(v - scores[s]) < 1e-9 for s, v in got.items())


def test_planted_items_are_found_and_nothing_else(spark):
    documents, benchmark = read(spark, MEDIUM, "documents"), read(spark, MEDIUM, "benchmark")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {(d, i) for d, t in rows for i, item in items if item in t}
    got = leaks(documents, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want
    clean = without_leaks(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_long_items_edits_and_odd_rows(spark, documents):
    rng = random.Random(2)
    prose = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    long_item, short_item = prose(300), prose(20)
    edited = [w if k % 15 else "zzz" for k, w in enumerate(short_item)]
    benchmark = spark.createDataFrame(
        [(1, " ".join(long_item)), (2, " ".join(short_item)), (2, " ".join(short_item)), (3, None), (4, ""), (5, "two words")],
        "item_id long, text string",
    )
    frame = documents(
        [
            (10, " ".join(prose(500) + long_item + prose(500))),
            (11, " ".join(prose(7) + edited + prose(300))),
            (12, " ".join(short_item[:10] + prose(200))),
            (13, None), (14, ""), (15, "two words"), (None, " ".join(short_item)), (11, " ".join(short_item)),
        ]
    )
    got = sorted(((r["doc_id"], r["item_id"]) for r in leaks(frame, benchmark).collect()), key=str)
    assert got == sorted([(10, 1), (11, 2), (11, 2), (11, 2), (11, 2), (None, 2), (None, 2)], key=str)
    many = leaks(frame, benchmark, Parameters(shard_bytes=200)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in many} == set(got)
    assert leaks(frame.where("false"), benchmark).collect() == []
    assert leaks(frame, benchmark.where("false")).collect() == []


def test_item_parts():
    assert item_parts("Who? Me. ") == ("Who?", " Me. ")
    assert item_parts("a b c") == ("a b", "c")
    assert item_parts("a b c?") == ("a b", "c?")


def test_short_answers_and_short_items(documents, spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    items = [
        (1, "What is the capital of France? Paris"),
        (2, "Who painted the famous Mona Lisa portrait? Leonardo Vinci"),
        (3, "Why? Because light of short wavelengths scatters more"),
        (4, "one two three four five"),
        (5, "Capital of Spain? Madrid"),
        (6, "six times seven"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(10 + i, f"{prose(300)} {item} {prose(300)}") for i, item in items]
    rows += [(20 + i, item) for i, item in items]
    # The question without its answer, short items in parts or in another order, and a text shorter than they.
    rows += [(30, f"{prose(200)} What is the capital of France? {prose(400)} Paris"), (31, "Capital of Spain? Lisbon"),
             (32, "seven times six"), (33, "six times"), (34, f"six {prose(1)} times seven")]
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents(rows), benchmark).collect()}
    assert got == {(10 + i, i) for i, _ in items} | {(20 + i, i) for i, _ in items}
    assert {r["doc_id"] for r in without_leaks(documents(rows), benchmark).collect()} == {30, 31, 32, 33, 34}


def test_punctuation_and_case_around_words(documents, spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    question = "What is the name of the river that runs through the old capital of the northern province?"
    benchmark = spark.createDataFrame([(1, f"{question} Paris"), (2, "six times seven")], "item_id long, text string")
    tails = ["Paris and more", "Paris. And more", "(Paris)", "Answer: PARIS, of course", "“Paris”", "«Paris» …", "- Paris -"]
    rows = [(10 + k, f"{prose(200)} {question} {tail} {prose(200)}") for k, tail in enumerate(tails)]
    rows += [(20, f"{prose(50)} 'six times seven'! {prose(50)}"), (21, "Six, times: SEVEN."), (22, "— six … times seven")]
    clean = [(30, f"{prose(200)} {question} Parisian {prose(200)}"), (31, "six times sevenths"), (32, "... !!! …"), (33, "")]
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents(rows + clean), benchmark).collect()}
    assert got == {(10 + k, 1) for k in range(len(tails))} | {(20, 2), (21, 2), (22, 2)}


def test_bare_words_keep_inner_marks():
    texts = ["it's (well-known)", "", "...", "“a”b” «c»。 don’t", "x"]
    hashes, bounds = bare_words(*word_hashes.column_bytes(pa.array(texts)))
    expected = [["it's", "well-known"], [], [], ["a”b", "c", "don’t"], ["x"]]
    for k, words in enumerate(expected):
        own = hashes[bounds[k] : bounds[k + 1]].tolist()
        assert own == [word_hashes.words(*word_hashes.column_bytes(pa.array([w])))[2][0] for w in words]


def test_places_of_a_short_item():
    parameters = Parameters()
    index = Index(((1, "six times seven"),), parameters)
    for n, at in [(3, 0), (95, 46), (97, 46), (97, 94), (300, 47), (300, 140), (300, 297)]:
        words = [f"v{i}" for i in range(n)]
        words[at : at + 3] = ["six", "times", "seven"]
        hashes = np.concatenate([_hashes(w) for w in words])
        ((row, item, *_, passages, first),) = index.search(hashes, np.array([0, n]))
        count = max(1, -(-(n - 96) // 48) + 1)
        holding = [p for p in range(count) if p * 48 <= at and at + 3 <= p * 48 + 96]
        assert (row, item, passages, first) == (0, 0, len(holding), holding[0] * 48)


def test_items_of_one_and_two_words_on_request(documents, spark):
    benchmark = spark.createDataFrame([(1, "two words"), (2, "Paris"), (3, "")], "item_id long, text string")
    rows = [(1, "some (two words)."), (2, "PARIS!"), (3, "two"), (4, "two other words"), (5, ""), (6, "two words of paris")]
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents(rows), benchmark, Parameters(verbatim_words=1)).collect()}
    assert got == {(1, 1), (2, 2), (6, 1), (6, 2)}
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents(rows), benchmark, Parameters(verbatim_words=2)).collect()}
    assert got == {(1, 1), (6, 1)}


def exhaustive(rows, items, parameters):
    """Every passage against every segment, without an index."""
    split = lambda text: [w for w in (w.strip(string.punctuation).lower() for w in (text or "").split()) if w]
    grams = lambda words, size: {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    stride = parameters.stride
    segments = []
    for number, (_, text) in enumerate(items):
        words = split(text)
        if len(words) >= parameters.min_words:
            segments += [(number, list(s)) for s in np.array_split(words, math.ceil(len(words) / stride))]
    df = Counter(w for _, s in segments for w in set(s))
    mean = sum(len(s) for _, s in segments) / max(1, len(segments))

    def impacts(segment):
        weights = {}
        for word, tf in Counter(segment).items():
            idf = math.log(1 + (len(segments) - df[word] + 0.5) / (df[word] + 0.5))
            weights[word] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(segment) / mean))
        return {w: x / sum(weights.values()) for w, x in weights.items()}

    indexed = [(number, impacts(s)) for number, s in segments]
    for doc_id, text in rows:
        words, found = split(text), {}
        count = max(1, -(-(len(words) - 2 * stride) // stride) + 1) if words else 0
        for p in range(count):
            passage = set(words[p * stride : (p + 2) * stride])
            for number, weights in indexed:
                score = sum(x for w, x in weights.items() if w in passage)
                if score < parameters.threshold - 1e-6:
                    continue
                length = len(split(items[number][1]))
                near = words[max(0, p * stride - length) : (p + 2) * stride + length]
                shares = []
                for part in map(split, item_parts(items[number][1])):
                    size = max(1, min(3, len(part)))
                    own = grams(part, size)
                    shares.append(len(own & grams(near, size)) / len(own) if own else 1.0)
                if min(shares) >= parameters.overlap:
                    old = found.setdefault(number, [0.0, 0.0, 0.0, set(), p * stride])
                    old[:4] = max(old[0], score), max(old[1], shares[0]), max(old[2], shares[1]), old[3] | {p}
        for number, (score, question, answer, passages, start) in found.items():
            yield doc_id, items[number][0], round(score, 4), round(question, 6), round(answer, 6), len(passages), start


@pytest.mark.parametrize(
    "seed, parameters",
    [(1, Parameters()), (2, Parameters(stride=8, threshold=0.3, overlap=0.2)), (3, Parameters(threshold=0.8))],
)
def test_whole_query_against_every_passage_and_item(documents, spark, seed, parameters):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice(["the", "of", "and", f"v{rng.randrange(300)}"]) for _ in range(n)]
    items, rows = [], []
    for number in range(40):
        words = prose(rng.choice([5, 6, 9, 20, 60, 130]))
        if number % 2:
            words[len(words) // 2] += "?"
        items.append((number, " ".join(words)))
    items.append((7, items[7][1]))
    for doc_id in range(40):
        words = prose(rng.choice([0, 3, 90, 97, 400]))
        leak = [w if rng.random() > rng.choice([0, 0.1, 0.4]) else "zzz" for w in rng.choice(items)[1].split()]
        at = rng.randrange(len(words) + 1)
        rows.append((doc_id, " ".join(words[:at] + leak[: rng.choice([len(leak), len(leak) // 2 + 1])] + words[at:])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [
        (r["doc_id"], r["item_id"], round(r["score"], 4), round(r["question_overlap"], 6), round(r["answer_overlap"], 6),
         r["n_passages"], r["first_word"])
        for r in leaks(documents(rows), benchmark, parameters).collect()
    ]
    want = sorted(exhaustive(rows, items, parameters))
    assert sorted(got) == want and len(want) > 10
    clean = {r["doc_id"] for r in without_leaks(documents(rows), benchmark, parameters).collect()}
    assert clean == {d for d, _ in rows} - {w[0] for w in want}


def test_repeated_rows_do_not_grow_the_sample(spark):
    rows, labels = corpus(300)
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = once.unionByName(once.where("doc_id < 30").crossJoin(spark.range(40).select()))
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    bounds = dict(sample_toxic=40, sample_ordinary=90)
    models = [fit(frame, truth, ToxicityParameters(**bounds)) for frame in (once, often)]
    assert models[0] == models[1]
