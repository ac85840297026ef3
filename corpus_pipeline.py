"""From raw documents to token ids in five stages.

Each stage is a function of (spark, docs, sf_dir). ``run`` writes what a stage
returns as Parquet in the shared folder and gives it to the next one. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    compression_toxicity,
    decontaminate,
    ngram_join,
    piece_tokenizer,
    repeat_intervals,
)
from tradewind.llm.components import stored
from tradewind.llm.queries import piece_model, ship_package
from tradewind.llm.tables import read

# Shortest repeated string that a stage cuts: passages of over 50 words are longer.
PASSAGE_BYTES = 200

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts. It learns from the labelled ones among its input."""
    ship_package(spark)
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = compression_toxicity.fit(docs.select("doc_id", "text"), compression_toxicity.learnable(labels))
    return compression_toxicity.without_toxic(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of copies and near copies."""
    ship_package(spark)
    return ngram_join.first_of_each_component(docs).select(docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once."""
    ship_package(spark)
    return repeat_intervals.without_repeats(docs, PASSAGE_BYTES)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    ship_package(spark)
    return piece_tokenizer.encode_documents(docs, piece_model(), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("suffix_dedup", cut_passages),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

# Training dictionaries, sketches of sets and merges are not for SQL; the tests hold
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
