"""Times the whole job on synthetic CSV files; prints one JSON line.

BENCH_JOB_MB sets the size of the input, BENCH_CPUS the local cores and
BENCH_JOB_DIR the working folder (an existing `csv` folder in it is used again).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aislewise.plans import ingest  # noqa: E402
from aislewise.plans.analysis import FROM_EVENTS, FROM_RESULT  # noqa: E402
from aislewise.session import build_session, size_shuffles  # noqa: E402
from aislewise.sinks import write_result  # noqa: E402
from aislewise.sources import load_events, write_synthetic_csv  # noqa: E402


def main() -> None:
    size_mb = int(os.environ.get("BENCH_JOB_MB", "1000"))
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    folder = os.environ.get("BENCH_JOB_DIR") or tempfile.mkdtemp(prefix="bench-job-")
    inputs, results = f"{folder}/csv", f"{folder}/results"
    validated = f"{folder}/validated-{time.time_ns()}"
    spark = build_session(
        "bench-job",
        master=f"local[{cpus}]",
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.local.dir": f"{folder}/local",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.isdir(inputs):
        write_synthetic_csv(spark, inputs, size_mb, events_per_session=5)
    size_shuffles(spark, [inputs])

    seconds = {}

    def timed(name: str, work: Callable[[], object]) -> object:
        start = time.perf_counter()
        outcome = work()
        seconds[name] = round(time.perf_counter() - start, 1)
        return outcome

    outcome = timed("ingest", lambda: ingest(spark, inputs, validated))
    for name, build in FROM_EVENTS.items():
        timed(
            name,
            lambda: write_result(build(load_events(spark, validated)), f"{results}/{name}"),
        )
    for name, (source, build) in FROM_RESULT.items():
        stored = spark.read.parquet(f"{results}/{source}")
        timed(name, lambda: write_result(build(stored), f"{results}/{name}"))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "job_time",
                "value": round(sum(seconds.values()), 1),
                "unit": "sec",
                "input_mb": size_mb,
                "rows": outcome.rows_written,
                "ingest_mb_per_sec": round(size_mb / seconds["ingest"], 1),
                "cpus": int(cpus),
                "steps": seconds,
            }
        )
    )


if __name__ == "__main__":
    main()
