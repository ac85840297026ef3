"""Run registered queries beside their SQL and compare the results."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "∅" if value is None else f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con, folder: str, build, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = build(spark, folder)
    mine = _rows(result.columns, result.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None


def main(folder: str, names: list[str]) -> int:
    from tests.conftest import test_session
    import __spark_entry__ as contract

    spark, con = test_session(), connect(folder)
    oracles, failures = contract.oracle_sql(), 0
    for name, build in contract.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            if name not in oracles:
                print(f"{name:38} {build(spark, folder).count()} rows, no SQL", flush=True)
                continue
            problem = difference(spark, con, folder, build, oracles[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{name:38} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("failures", failures, "missing", set(contract.queries()) ^ set(oracles))
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
