"""Removal of repeats against a table of all windows."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from tradewind.llm.repeat_intervals import cut_repeats, digests, prefix_intervals, without_repeats

L = 40


def covers(rows, length):
    """Each text's bytes, and which of them are repeated."""
    seen = collections.defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for r, text in enumerate(texts):
        for p in range(len(text) - length + 1):
            seen[text[p : p + length]].append((r, p))
    covered = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for r, p in places:
                covered[r][p : p + length] = True
    return [(np.frombuffer(t, np.uint8), c) for t, c in zip(texts, covered)]


def expected_texts(rows, length=L):
    return [text[~cover].tobytes().decode("utf-8", "ignore") for text, cover in covers(rows, length)]


def expected(rows, length=L):
    out = []
    for (doc_id, _), (text, cover) in zip(rows, covers(rows, length)):
        runs = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((doc_id, len(text), int(cover.sum()), runs, hashlib.sha256(text[~cover].tobytes()).hexdigest()))
    return sorted(out, key=str)


def removed(frame, **options):
    return sorted((tuple(r) for r in digests(cut_repeats(frame, L, **options)).collect()), key=str)


def fixture(seed=5):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choices("abcdé fgh", k=n))
    passages = [some(rng.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [some(rng.randint(0, 60)), rng.choice(passages)[rng.randint(0, 10) :]]
        rows.append((i, "".join(parts)))
    base = some(300)
    for i in range(100, 130):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        rows.append((i, "".join(text)))
    rows += [(200, None), (201, ""), (None, passages[0] + passages[1]), (None, some(50)), (5, passages[2])]
    rows += [(300, "a" * 150), (301, "ab" * 50), (301, "ab" * 50), (302, "xyz" + "a" * 60)]
    return rows


@pytest.mark.parametrize("most_suffixes", [4096, 1])
def test_removed_bytes_equal_brute_force(documents, most_suffixes):
    rows = fixture()
    assert removed(documents(rows), most_suffixes=most_suffixes) == expected(rows)


def test_shortest_repeat_and_none(documents):
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghijkl", k=300))
    for size, spans in ((L, 1), (L - 1, 0)):
        rows = [(1, text), (2, "0" + text[100 : 100 + size] + "1")]
        got = removed(documents(rows))
        assert got == expected(rows) and [r[3] for r in got] == [spans, spans]
    assert removed(documents(rows).where("false")) == []


def test_kept_texts_and_columns(spark):
    passage = "é" * 30
    frame = spark.createDataFrame(
        [(1, "x" + passage + "left", "n", 7), (2, passage + "right", "m", 8), (3, None, None, None)],
        "doc_id long, text string, start string, n_bytes long",
    )
    got = without_repeats(frame, L)
    assert got.columns == frame.columns
    rows = {r["doc_id"]: (r["text"], r["start"], r["n_bytes"]) for r in got.collect()}
    assert rows == {1: ("xleft", "n", 7), 2: ("right", "m", 8), 3: (None, None, None)}


def test_clashing_columns_and_characters_cut_in_two(spark):
    passage = "é" * 30
    clashing = ("__id", "__text", "__key", "__spans", "c0", "kept", "h")
    frame = spark.createDataFrame(
        [(1, "x" + passage + "left", *clashing), (2, passage + "right", *clashing)],
        "doc_id long, text string, " + ", ".join(f"{c} string" for c in clashing),
    )
    got = without_repeats(frame, L)
    assert got.columns == frame.columns
    assert {tuple(r)[2:] for r in got.collect()} == {clashing}
    assert {r["text"] for r in digests(cut_repeats(frame, L), with_text=True).collect()} == {"xleft", "right"}
    # The repeat starts in the middle of a character.
    tail = "\u00a9" + "b" * L  # C2 A9
    other = "\u00e9"[:1]  # C3 A9
    rows = [(1, "x" + tail), (2, "y" + other + "b" * L)]
    two = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["text"] for r in digests(cut_repeats(two, L), with_text=True).collect()} == {"x", "y"}


def test_intervals_of_a_prefix_array():
    # Common prefixes of: banana's sorted suffixes a, ana, anana, banana, na, nana.
    assert sorted(prefix_intervals(np.array([0, 1, 3, 0, 0, 2]))) == [(0, 0, 5), (1, 0, 2), (2, 4, 5), (3, 1, 2)]
