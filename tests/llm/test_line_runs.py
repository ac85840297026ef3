"""Line dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LOWER
from tradewind.llm import line_runs

COMMON = "  A line that very many documents hold\t"
ODD = [
    (1, COMMON + "\nown words of the first document"),
    (2, "\n" + COMMON.strip().upper() + "\r\n\n"),
    (3, COMMON + "\nsecond\n" + COMMON.lower()),
    (4, None),
    (5, ""),
    (6, "\n\n\n"),
    (7, "nineteen characters\nnineteen characters"),
    (8, "éééééééééééééééééééé"),
    (9, "éééééééééééééééééééé\nÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ"),
    (10, "éééééééééééééééééééé"),
    (11, " éééééééééééééééééééé"),
    (-3, COMMON),
]


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows, least_docs=3):
    holders = defaultdict(set)
    number = lambda d: -(1 << 63) if d is None else d
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders[key_of(line)].add(number(doc_id))
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [
            x for x in lines
            if len(key_of(x)) < 20 or len(holders[key_of(x)]) < least_docs or max(holders[key_of(x)]) == number(doc_id)
        ]
        digest = hashlib.sha256("\n".join(stay).encode()).hexdigest()
        yield doc_id, len(lines), len(lines) - len(stay), digest


def check(frame, rows, **options):
    got = map(tuple, line_runs.digests(line_runs.dedupe_lines(frame, **options)).collect())
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_odd_rows(documents):
    check(documents(ODD), ODD)


def test_null_ids_and_repeated_rows(documents):
    rows = [(None, COMMON), (None, COMMON + "\nmore"), (1, COMMON), (1, COMMON), (2, COMMON + "\n" + COMMON), (2, "x")] * 2
    check(documents(rows), rows)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (7, 2), (9, 3)])
def test_any_number_of_batches_and_levels(documents, batches, fanout):
    rng = random.Random(batches)
    pool = [f"a line of the pool with number {n}" for n in range(60)]
    rows = [(d, "\n".join(rng.choices(pool, k=rng.randint(0, 6)))) for d in range(120)]
    check(documents(rows), rows, batches=batches, fanout=fanout)


def test_empty_table_and_clashing_columns(spark, documents):
    assert line_runs.dedupe_lines(documents(ODD).where("false")).collect() == []
    clashing = documents(ODD).select(
        "doc_id", "text", F.lit("a").alias("row"), F.lit("b").alias("lines"), F.lit("c").alias("kept"),
        F.lit(1).alias("id"), F.lit("d").alias("th"), F.lit("e").alias("a.b"),
    )
    cut = line_runs.without_repeated_lines(clashing)
    assert cut.columns == clashing.columns
    assert {tuple(r)[2:] for r in cut.collect()} == {("a", "b", "c", 1, "d", "e")}
    assert [r["text"] for r in cut.collect() if r["doc_id"] == 4] == [None]


def test_very_long_text(documents):
    long = "\n".join(f"line {n % 7000} of a very long text" for n in range(40_000))
    rows = [(1, long), (2, long), (3, long + "\n" + COMMON), (4, COMMON)]
    check(documents(rows), rows)


def test_runs_are_disjoint_and_joined_without_a_shuffle(spark, capsys):
    index = line_runs.LineRuns(spark, buckets=4)
    batch = lambda first: spark.range(first, first + 100).select(
        F.col("id").alias("h1"), (F.col("id") * 3).alias("h2"), F.lit(1).alias("docs"), F.col("id").alias("newest")
    )
    for first in (0, 50, 0, 120, 300):
        index.add(batch(first))
    keys = [r["h1"] for run in index.runs for r in run.collect()]
    assert sorted(keys) == sorted({*range(0, 220), *range(300, 400)})
    assert len(index.runs) == 2
    docs = {r["h1"]: r["docs"] for r in index.tally().collect()}
    assert (docs[10], docs[60], docs[130], docs[210], docs[310]) == (2, 3, 2, 1, 1)
    line_runs._not_in(index.runs[0], index.runs[1]).explain()
    line_runs._merged(index.runs[0], index.runs[1]).explain()
    plan = capsys.readouterr().out
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    index.close()
