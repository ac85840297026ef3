"""Mined negatives against all pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tradewind.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def expected(rows, every=10, positives=5, negatives=3):
    usable = {
        (d, label, tuple(math.floor(256 * x) for x in v))
        for d, label, v in rows
        if d is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for anchor in usable:
        if anchor[0] % every:
            continue
        others = sorted((-score(anchor, r), r[0], r) for r in usable if r != anchor)
        for p, p_id, _ in [o for o in others if o[2][1] == anchor[1]][:positives]:
            fits = [o for o in others if o[2][1] != anchor[1] and 50 * -p <= 100 * -o[0] <= 95 * -p]
            out += [(anchor[0], p_id, k, n_id, -p, -n) for k, (n, n_id, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(frame, every=10, **options):
    found = hard_negatives.mine(hard_negatives.scaled_vectors(frame), F.col("id") % every == 0, **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


@pytest.fixture
def embeddings(spark):
    return lambda rows, partitions=3: spark.createDataFrame(rows, SCHEMA).repartition(partitions)


@pytest.mark.parametrize("seed, blocks", [(1, 1024), (2, 16), (3, 7)])
def test_random_vectors(embeddings, monkeypatch, seed, blocks):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(hard_negatives, "ROWS_PER_GROUP", 4 * blocks)
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(d, rng.randrange(3), [rng.choice([0.25, 0.5]) * x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for d in range(300)]
    found = mined(embeddings(rows))
    assert found == expected(rows) and len(found) > 50


def test_ties_hot_vectors_and_repeats(embeddings):
    same = [0.5, 0.25, 0.0]
    near = [0.25, 0.25, 0.5]
    rows = [(d, d % 2, same) for d in range(60)] + [(100 + d, d % 2, near) for d in range(60)]
    rows += rows[:5] + [(10, 1, near), (10, 0, near), (10, 0, near)]
    assert mined(embeddings(rows)) == expected(rows)


def test_rows_that_take_no_part(embeddings):
    good = [(d, d % 2, [0.1 * d, 1.0 - 0.05 * d]) for d in range(22)]
    odd = [
        (30, None, [1.0, 1.0]), (40, 1, None), (50, 1, [1.0, None]), (60, 0, [float("nan"), 1.0]),
        (70, 0, [float("inf"), 1.0]), (None, 0, [1.0, 1.0]), (80, 0, []), (90, 1, [1.0]), (81, 1, [-1.0, -1.0]),
    ]
    assert mined(embeddings(good + odd)) == expected(good + odd)


def test_empty_tables_and_lone_anchors(embeddings):
    one = [(10, 0, [1.0, 2.0])]
    assert mined(embeddings(one).where("false")) == []
    assert mined(embeddings(one)) == []
    assert mined(embeddings([*one, (11, 0, [1.0, 2.0])])) == []


def test_clashing_columns_and_very_long_vectors(spark, embeddings):
    rng = random.Random(4)
    rows = [(d, d % 2, [rng.random() for _ in range(20_000)]) for d in range(24)]
    frame = embeddings(rows).select("*", *[F.lit("x").alias(c) for c in ("id", "v", "row", "group", "low0", "number")])
    assert mined(frame) == expected(rows)


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 22)
    rows = [(d, d % 2, [big + d, big - d * d]) for d in range(0, 24)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(frame) == expected(rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        mined(spark.createDataFrame([(0, 0, [1e18]), (1, 0, [1e18])], "vec_id long, label int, embedding array<double>"))
