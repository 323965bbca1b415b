"""Parquet output."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import utc_without_zone
from aislewise.operators import cleaning_rules
from aislewise.schema import BLOCK_BYTES, CORRUPT
from aislewise.sources.files import list_files

# Bytes of a stored file to aim at.
FILE_BYTES = 2 * BLOCK_BYTES
# Partition values of lines that became events and of malformed ones.
GOOD, BAD = "good", "bad"


def write_validated(
    df: DataFrame, path: str, overwrite: bool = True, compact: bool = False
) -> None:
    """Events partitioned by event_type; appends when not overwriting.

    Without `compact` no data moves: each input split writes at most one file per
    event type. An overwrite takes away all earlier partitions, whatever the session
    says about partitions. With `compact` one shuffle evens out the file sizes; the adaptive
    rebalance cuts a large event type into several files instead of one task.
    """
    events = utc_without_zone(df)
    if compact:
        events = events.hint("rebalance", "event_type")
    mode = "overwrite" if overwrite else "append"
    writer = events.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy("event_type").parquet(path)


def grade_lines(parsed: DataFrame) -> DataFrame:
    """Parsed lines as one table of two kinds, to be written in one pass.

    status is `good` for rows that clean_events keeps and `bad` for malformed lines; `line` is the text of the
    latter, whose other columns are null. Rows that cleaning drops are in neither kind.
    """
    broken = F.col(CORRUPT).isNotNull()
    tags = [c for c in ("source_file", "source") if c in parsed.columns]
    values = [c for c in parsed.columns if c not in (CORRUPT, *tags)]
    clean = functools.reduce(Column.__and__, cleaning_rules(parsed))
    kept = utc_without_zone(parsed.filter(broken | clean))
    return kept.select(
        F.when(broken, BAD).otherwise(GOOD).alias("status"),
        *tags,
        *[F.when(~broken, F.col(c)).alias(c) for c in values],
        F.col(CORRUPT).alias("line"),
    )


def write_graded(graded: DataFrame, path: str, *keys: str, replace_all: bool = False) -> None:
    """Graded lines below status, further keys and event_type, each read by its partition alone.

    No data moves. Partitions that the rows have are replaced; others stay unless `replace_all` says otherwise.
    """
    overwrite = "static" if replace_all else "dynamic"
    writer = graded.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy("status", *keys, "event_type").parquet(path)


def pack_types(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> list[str]:
    """Rewrite the event types that lie in many small files; the others are not read.

    A split writes a file of each type, so rare types end up in files far below `file_bytes`. A type is
    packed if it has more than twice the files its bytes ask for, into no more than these. Rows are dealt
    evenly, whatever they hold. Each type's partition is replaced when the job commits; a
    crash at that moment can lose it, so pack before a table is declared complete, as ingest does.
    Returns the types that were packed.
    """
    files = list_files(spark, path, "*.parquet").select(
        F.regexp_extract("path", "/event_type=([^/]*)/", 1).alias("event_type"), "length"
    )
    needed = F.greatest(F.ceil(F.sum("length") / file_bytes), F.lit(1)).cast("int")
    types = files.groupBy("event_type").agg(F.count("*").alias("files"), needed.alias("parts"))
    # One row per event type.
    packed = {r.event_type: r.parts for r in types.where("files > 2 * parts").collect()}
    if not packed:
        return []
    stored = spark.read.parquet(path).where(F.col("event_type").isin(*packed))
    parts = functools.reduce(
        lambda rest, one: F.when(F.col("event_type") == one[0], F.lit(one[1])).otherwise(rest),
        packed.items(),
        F.lit(1),
    )
    place = F.pmod(F.monotonically_increasing_id(), parts)
    dealt = stored.withColumn("_place", place).repartition(sum(packed.values()), "event_type", "_place")
    writer = dealt.drop("_place").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_type").parquet(path)
    return sorted(packed)


def write_result(df: DataFrame, path: str) -> None:
    """A result table, replacing an earlier one.

    Adaptive execution merges the partitions of a small result into one file and
    leaves a large one spread out, so the row order is not part of the contract.
    """
    df.write.mode("overwrite").parquet(path)


def preview(spark: SparkSession, path: str, *order: Column, rows: int = 10) -> DataFrame:
    """First rows of a stored result in the given order; files carry none."""
    return spark.read.parquet(path).orderBy(*order).limit(rows)
