from __future__ import annotations

import re

import pytest

from tradewind.llm.queries import ship_package

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="session")
def spark(spark):
    """The session of the other tests, with this package on its executors."""
    ship_package(spark)
    return spark


@pytest.fixture
def documents(spark):
    """Frames of documents from (doc_id, text) rows."""

    def build(rows, partitions: int = 2):
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)

    return build


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text: str | None) -> frozenset:
    words = words_of(text)
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()
