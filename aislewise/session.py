"""Session settings and the size of shuffles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aislewise.schema import BLOCK_BYTES

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(BLOCK_BYTES),
    # Files of other writers may hold INT96 times; read them without a calendar shift.
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Splits of one scan; a larger input gets larger splits, so that files and tasks stay manageable.
MOST_SPLITS = 200_000
# Input bytes per shuffle partition; adaptive execution merges those that turn out small.
BYTES_PER_PARTITION = 2 * BLOCK_BYTES
LEAST_PARTITIONS = 200
# Blocks of one shuffle: map tasks times reduce tasks. The driver keeps about a bit for each.
MOST_BLOCKS = 1 << 32


def build_session(
    app_name: str = "aislewise",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with `extra` and those SETTINGS that spark-submit does not set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def _given(spark: SparkSession, key: str) -> bool:
    """Whether the session was started with a value of its own for a setting."""
    return spark.sparkContext.getConf().contains(key)


def size_shuffles(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    most: int | None = None,
) -> None:
    """Fit the number of shuffle partitions and the split size to the input unless they were given.

    An aggregation by session can shuffle a good part of the input, and adaptive
    execution merges partitions of an aggregation but never cuts one. `pattern` selects
    files; `most` is the number of bytes that will be read if that is less, as in sample mode.
    """
    shuffles, splits = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    if _given(spark, shuffles) and _given(spark, splits):
        return
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # The content column is not selected, so only the file listing is read.
    files = reader.load([paths] if isinstance(paths, str) else list(paths))
    total = files.agg(F.sum("length").alias("total")).first().total or 0
    if most is not None:
        total = min(total, most)
    if not _given(spark, shuffles):
        spark.conf.set(shuffles, max(total // BYTES_PER_PARTITION, LEAST_PARTITIONS))
    if not _given(spark, splits):
        blocks = max(1, -(-total // (BLOCK_BYTES * MOST_SPLITS)))
        spark.conf.set(splits, blocks * BLOCK_BYTES)


class AggregationPlan(NamedTuple):
    """Sizes for a scan and the shuffle of its aggregation."""

    split_bytes: int
    map_tasks: int
    shuffled_bytes: int
    partitions: int


def plan_aggregation(scan_bytes: int, rows: int, groups: int, row_bytes: int) -> AggregationPlan:
    """Splits and shuffle partitions for an aggregation of `rows` rows to `groups` groups.

    `scan_bytes` are the bytes of the columns it reads, `row_bytes` those of a combined row. A map task
    combines its rows first, so it hands on a row for each group it meets: all of them where groups
    are few, as many as it has rows where they are many. What is shuffled decides on the
    partitions. Where tasks on both sides would make more blocks than MOST_BLOCKS, both get larger
    by the same factor.
    """
    scan_bytes, rows, groups = max(scan_bytes, 1), max(rows, 1), max(groups, 1)

    def shuffled_by(tasks: int) -> int:
        in_task = rows / tasks
        # Expected groups that a task meets if rows fall anywhere.
        met = min(in_task, groups * -math.expm1(-in_task / groups))
        return math.ceil(tasks * met * row_bytes)

    map_tasks = min(-(-scan_bytes // BLOCK_BYTES), MOST_SPLITS)
    shuffled = shuffled_by(map_tasks)
    partitions = -(-shuffled // BYTES_PER_PARTITION)
    excess = map_tasks * partitions / MOST_BLOCKS
    if excess > 1:
        map_tasks = max(1, int(map_tasks / math.sqrt(excess)))
        # Larger tasks combine more.
        shuffled = shuffled_by(map_tasks)
        partitions = min(-(-shuffled // BYTES_PER_PARTITION), MOST_BLOCKS // map_tasks)
    partitions = max(partitions, LEAST_PARTITIONS)
    return AggregationPlan(-(-scan_bytes // map_tasks), map_tasks, shuffled, partitions)


def apply_plan(spark: SparkSession, plan: AggregationPlan) -> None:
    """Set what the session was not started with."""
    chosen = {
        "spark.sql.shuffle.partitions": plan.partitions,
        "spark.sql.files.maxPartitionBytes": max(plan.split_bytes, BLOCK_BYTES),
    }
    for key, value in chosen.items():
        if not _given(spark, key):
            spark.conf.set(key, value)
