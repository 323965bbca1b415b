"""Times every registered query; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the tables, the local cores and the
number of measured runs. Each query runs once to warm up; its time is the median of
the measured runs, building the plan and writing all rows to the noop sink included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aislewise.session import build_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name, query in QUERIES.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
