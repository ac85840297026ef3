"""Periodic runs against all periods of small texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import periodic_runs


def runs_of(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            first = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > first and i - first + q >= max(least, exponent * q):
                found.setdefault((first, i - first + q), q)
            i += i == first
    return sorted((s, n, q) for (s, n), q in found.items())


def report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_of(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = (None,) * 4
    for s, m, q in runs:
        if best[0] is None or m * best[2] > best[1] * q:
            best = (s, m, q, 1000 * m // q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))


def check(frame, rows):
    got = map(tuple, periodic_runs.digests(periodic_runs.collapse_runs(periodic_runs.with_periods(frame))).collect())
    assert sorted(got, key=str) == sorted((report(*r) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choices("abcd"[: rng.randint(1, 4)], k=rng.choice([0, 3, 9, 40, 150]))
            if words and rng.random() < 0.7:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // (3 + rng.randrange(8))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        hashes = np.array([ord(w) for t in texts for w in t], np.uint64)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = list(zip(*(x.tolist() for x in periodic_runs.find_runs(hashes, bounds))))
        assert got == [(k, *r) for k, t in enumerate(texts) for r in runs_of(t)]


def test_stretches_keep_every_run():
    hashes = np.array([5, 6, 7, 1, 2, 1, 2, 1, 2, 1, 2, 9, 1, 5, 6, 7], np.uint64)
    at, group = periodic_runs.frequent_stretches(hashes, np.zeros(len(hashes), np.int64), 6, 4)
    assert at.tolist() == list(range(3, 11)) and set(group.tolist()) == {0}


def test_whole_rows(documents):
    rng = random.Random(9)
    rows = []
    for doc_id in range(-20, 180):
        words = rng.choices(["a", "b", "É", "éé", "漢"], k=rng.choice([0, 1, 7, 30, 90]))
        if rng.random() < 0.5:
            words = words[:5] + words[5:9] * rng.randint(1, 9) + words[9:]
        rows.append((doc_id, rng.choice([" ", "\n", " \t "]).join(words)))
    check(documents(rows), rows)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 50), (None, "b " * 30), (None, "x y " * 4), (5, "A a " * 6), (5, "A a " * 6)]
    check(documents(rows), rows)
    frame = documents(rows).where("false")
    assert periodic_runs.digests(periodic_runs.collapse_runs(periodic_runs.with_periods(frame))).collect() == []


def test_clashing_columns_and_general_use(documents):
    frame = documents([(1, "go " * 8 + "home")]).select(
        "doc_id", "text", F.lit("x").alias("words"), F.lit("y").alias("best"), F.lit("old").alias("collapsed"), F.lit(0).alias("runs")
    )
    row = periodic_runs.collapse_runs(frame).first()
    assert (row["words"], row["best"], row["collapsed"]) == ("x", "y", "go home")
    assert [tuple(r) for r in row["runs"]] == [(0, 8, 1)]
    doubled = documents([(1, "so it is so it is now")])
    row = periodic_runs.collapse_runs(doubled, least_words=2, least_exponent=2).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 6, 3)] and row["collapsed"] == "so it is now"


def test_very_long_text(documents):
    unit = [f"w{n}" for n in range(3000)]
    text = " ".join(["start", *unit * 40, "end", *["same"] * 50_000])
    row = periodic_runs.collapse_runs(documents([(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 120_000, 3000), (120_002, 50_000, 1)]
    assert row["collapsed"] == " ".join(["start", *unit, "end", "same"])
