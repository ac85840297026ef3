"""The similarity join against all pairs."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tests.llm.conftest import shingle_set
from tradewind.llm import ngram_join
from tradewind.llm.components import connected_components
from tradewind.llm.ngram_join import first_of_each_component, join_documents, link_counts


def expected(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in sets}


def joined(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in join_documents(frame).collect()}


def fixture():
    """Near copies in numbers, a common line, a common passage, boilerplate, short texts."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]

    def edited(words, rate):
        return [rng.choice(vocabulary) if rng.random() < rate else w for w in words]

    base, line, passage = (rng.choices(vocabulary, k=n) for n in (120, 12, 50))
    rows = [edited(base, rng.choice([0.0, 0.01, 0.02, 0.04])) for _ in range(70)]
    rows += [line + rng.choices(vocabulary, k=rng.randint(3, 80)) for _ in range(60)]
    rows += [rng.choices(vocabulary, k=50) + passage + rng.choices(vocabulary, k=rng.randint(0, 30)) for _ in range(50)]
    rows += [edited(line * 3 + passage, 0.02) for _ in range(45)]
    rows += [rng.choices(vocabulary[:3], k=rng.randint(0, 7)) for _ in range(25)]
    rng.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


def test_components_equal_all_pairs(documents):
    rows = fixture()
    assert joined(documents(rows)) == expected(rows)


def test_link_counts_equal_all_pairs(documents):
    rows = [*fixture(), (300, None), (301, "")]
    sets = {d: shingle_set(t) for d, t in rows}
    want = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            want[a] += 1
            want[b] += 1
    got = {r["doc_id"]: r["n_links"] for r in link_counts(documents(rows)).collect()}
    assert got == want and max(want.values()) > ngram_join.SHORT_LIST


def test_threshold_is_met_exactly(documents):
    # 7 shingles; sharing 6 of 8 is 75 percent, 5 of 9 is less.
    words = [f"w{i}" for i in range(11)]
    rows = [(3, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (9, " ".join([*words[:-2], "x", "y"]))]
    assert expected(rows)[2][1] == 2 and expected(rows)[3][1] == 2 and expected(rows)[9][1] == 9
    assert joined(documents(rows)) == expected(rows)
    far = [(1, " ".join(words)), (2, " ".join([*words[:-2], "x", "y"]))]
    assert joined(documents(far)) == expected(far) == {1: (7, 1), 2: (7, 2)}


def test_copies_nulls_and_case(documents):
    rows = [(5, "A b c"), (4, "a  B\nc "), (4, "a b c"), (7, None), (8, ""), (9, " \t"), (None, "a b c"), (None, None)]
    got = sorted((tuple(r) for r in join_documents(documents(rows)).collect()), key=str)
    assert got == sorted(
        [(5, 1, 4), (4, 1, 4), (4, 1, 4), (7, 0, 7), (8, 0, 8), (9, 0, 9), (None, 1, 4), (None, 0, None)], key=str
    )
    assert join_documents(documents(rows).where("false")).collect() == []


def test_first_of_each_component_keeps_columns(spark):
    rows = [(1, "a b c", "x"), (2, "a b c", "y"), (3, "other text", "z"), (4, "", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long".replace("n long", "node string"))
    got = first_of_each_component(frame)
    assert got.columns == frame.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4]


def test_first_of_each_component_picks_rows(spark):
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, long, "x")] * 3 + [(1, other, "x"), (1, other, "y"), (0, other + " end", "z")]
    rows += [(None, long, "n"), (None, "only null ids here", "a"), (None, "only null ids here", None)]
    rows += [(None, None, "e"), (None, None, "e"), (2, " \t", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row_key string").repartition(4)
    got = first_of_each_component(frame)
    assert got.columns == frame.columns
    got = [tuple(r) for r in got.collect()]
    assert sorted(r for r in got if r[0] is not None) == [(0, other + " end", "z"), (1, long, "x"), (2, " \t", "e")]
    nulls = sorted((r for r in got if r[0] is None), key=str)
    assert len(nulls) == 3 and nulls[1:] == [(None, None, "e")] * 2 and nulls[0][1] == "only null ids here"
    again = first_of_each_component(frame.repartition(3)).collect()
    assert sorted(map(str, map(tuple, again))) == sorted(map(str, got))


def test_bitmap_bound_never_excludes_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 80))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.unique(np.concatenate([a[: int(rng.integers(0, n + 1))], rng.integers(0, 1 << 63, 20).astype(np.uint64)]))
        a = np.unique(a)
        common = len(np.intersect1d(a, b))
        bound = ngram_join._most_common(ngram_join._set_bitmap(a), ngram_join._set_bitmap(b), len(a), len(b))
        assert bound >= common


@pytest.mark.parametrize("shape", ["path", "star", "two"])
def test_components_of_shapes(spark, shape):
    edges = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(100, i) for i in range(40)],
        "two": [(1, 2), (2, 3), (9, 8), (-5, 8), (3, 1)],
    }[shape]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(got)
    if shape == "two":
        assert got == {1: 1, 2: 1, 3: 1, 9: -5, 8: -5, -5: -5}
    else:
        assert set(got.values()) == {0} and len(got) == 41


def test_long_lists_are_dealt_without_their_members_other_keys(spark):
    """What a member of a long list carries must not grow with the number of its long lists."""
    lists = "array(named_struct('long_key', 7L, 'mark', 3L), named_struct('long_key', 8L, 'mark', -3L))"
    members = spark.range(3).selectExpr("id AS a", f"{lists} AS lists", "3L AS n", "unhex('0700000000000000') AS bits")
    roots = spark.createDataFrame([(0, 0), (1, 0)], "node long, root long")
    for many in (False, True):
        pairs = ngram_join._between_components(members, roots, 75, many)
        assert sorted((r["a"], r["b"]) for r in pairs.collect()) == [(0, 2), (1, 2)]
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        assert ("open_keys" in plan) is many
