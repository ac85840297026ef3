"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tradewind.registry.spark_queries import QUERIES  # noqa: E402
from tradewind.session import delete_scratch, spark_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [name for name in QUERIES if name.startswith(("P", "S", "W2", "W3"))]


def main() -> None:
    spark = spark_session(
        "tradewind-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    # The first query pays for class loading and code generation.
    QUERIES["P6_ceo_monthly"](spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
            delete_scratch(spark)
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
