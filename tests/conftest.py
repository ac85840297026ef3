from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradewind.session import delete_scratch, ensure_checkpoint_dir, spark_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def test_session():
    session = spark_session(
        "tradewind-tests",
        master="local[8]",
        shuffle_partitions=8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    return session


test_session.__test__ = False


@pytest.fixture(scope="session")
def spark():
    session = test_session()
    yield session
    delete_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Small typed frames from SQL VALUES lists."""

    def build(schema: str, rows: str):
        names = [part.split()[0] for part in schema.split(",")]
        casts = ", ".join(
            f"CAST({n} AS {part.split(None, 1)[1]}) AS {n}"
            for n, part in zip(names, schema.split(","))
        )
        return spark.sql(f"SELECT {casts} FROM VALUES {rows} AS t({', '.join(names)})")

    return build
