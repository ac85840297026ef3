"""The pipeline's stages, each on its predecessor's rows, against brute force."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_ngram_join import expected as expected_components
from tests.llm.test_repeat_intervals import expected_texts
from tradewind.llm.components import stored
from tradewind.llm.compression_toxicity import fit, learnable, score
from tradewind.llm.piece_tokenizer import PieceTokenizer
from tradewind.llm.queries import piece_model
from tradewind.llm.tables import read


@pytest.fixture(scope="module")
def outputs(spark):
    """The rows that each stage got and returned."""
    docs, seen = read(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SMALL), name)
        seen.append((docs, result))
        docs = result
    return seen


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_order_and_columns(spark, outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "suffix_dedup", "decontamination", "sentencepiece",
    ]
    for before, after in outputs[:-1]:
        assert after.columns == before.columns
        kept = {r["doc_id"]: r for r in before.drop("text").collect()}
        assert all(kept[r["doc_id"]] == r for r in after.drop("text").collect())


def test_toxic_documents_go(spark, outputs):
    before, after = outputs[0]
    labels = read(spark, SMALL, "labels").select("doc_id", "toxic")
    scores = score(before, fit(before, learnable(labels))).collect()
    assert set(texts(after)) == {r["doc_id"] for r in scores if r["score"] < 0.3}


def test_one_of_each_group_stays(outputs):
    before, after = outputs[1]
    rows = list(texts(before).items())
    want = {component if n else d for d, (n, component) in expected_components(rows).items()}
    assert set(texts(after)) == want


def test_repeated_passages_go(outputs):
    before, after = outputs[2]
    rows = list(texts(before).items())
    assert texts(after) == dict(zip([d for d, _ in rows], expected_texts(rows, corpus_pipeline.PASSAGE_BYTES)))


def test_leaking_documents_go(spark, outputs):
    before, after = outputs[3]
    items = [r["text"] for r in read(spark, SMALL, "benchmark").collect()]
    rows = texts(before)
    assert set(texts(after)) == {d for d, t in rows.items() if not any(i in t for i in items)}


def test_tokens(outputs):
    before, after = outputs[4]
    library, rows = PieceTokenizer(piece_model()).library, texts(before)
    got = {r["doc_id"]: r for r in after.collect()}
    assert set(got) == set(rows)
    for doc_id, text in rows.items():
        ids = library.encode(text)
        assert got[doc_id]["ids"] == ids
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, outputs):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, outputs[-1][1].collect()))


def test_no_documents(spark):
    docs = read(spark, SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []


def test_one_copy_of_repeated_rows_and_null_ids_is_left(spark):
    said = [" ".join(f"{name}{i}" for i in range(80)) for name in ("row", "null", "same", "near")]
    rows = [(1, said[0], "en")] * 4 + [(None, said[1], "en")] * 2 + [(None, said[1], "de")]
    rows += [(1, said[2], "en"), (7, said[2], "en"), (None, said[3], "en"), (None, said[3] + " end", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    left = corpus_pipeline.one_of_each(spark, docs, SMALL)
    assert left.columns == docs.columns
    got = [r["text"] for r in corpus_pipeline.cut_passages(spark, stored(left, "left"), SMALL).collect()]
    assert len(got) == 4
    assert sorted(t.removesuffix(" end") for t in got) == sorted(said)
