"""Session statistics, mergeable rollups, summary and sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from aislewise.functions import micros_between, micros_to_minutes, minutes_to_micros
from aislewise.operators.selection import exact_median

SAMPLE_SIZE = 500_000
# Hex digits of the md5 that make up one sample bucket: 16**4 buckets.
BUCKET_DIGITS = 4


def _event_measures() -> list[Column]:
    return [
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        F.count("*").alias("num_events"),
        F.sum("price").alias("total_spend"),
    ]


def _with_duration(sessions: DataFrame) -> DataFrame:
    micros = micros_between("session_start", "session_end")
    return sessions.withColumn("session_duration_min", micros_to_minutes(micros))


def session_stats(events: DataFrame) -> DataFrame:
    """Start, end, events, summed price of all event types and minutes per session.

    Rows are combined per session before the shuffle, so one session with a large
    share of all events costs one row per input task.
    """
    return _with_duration(events.groupBy("user_session").agg(*_event_measures()))


def session_partials(events: DataFrame, *keys: str) -> DataFrame:
    """Rollup rows per session and further keys, event_type unless others are named.

    Rollups of separate batches can be united and merged later without the events.
    """
    return events.groupBy("user_session", *(keys or ("event_type",))).agg(*_event_measures())


def merge_session_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """Session statistics from rollup rows; equal to session_stats of their events.

    Further `keys` are columns that are the same in all rows of a session.
    """
    return _with_duration(
        partials.groupBy(*keys, "user_session").agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("num_events").alias("num_events"),
            F.sum("total_spend").alias("total_spend"),
        )
    )


def session_summary(sessions: DataFrame, approx: bool = False) -> DataFrame:
    """One row: sessions, mean events, median minutes, mean spend.

    Reads `sessions` several times for the exact median; pass a stored table. With
    `approx` the median is a percentile sketch from a single pass.
    """
    means = [
        F.count("*").alias("num_sessions"),
        F.avg("num_events").alias("avg_events"),
        F.avg("total_spend").alias("avg_spend"),
    ]
    columns = ["num_sessions", "avg_events", "median_duration_min", "avg_spend"]
    if approx:
        sketch = F.percentile_approx("session_duration_min", 0.5, 10_000)
        return sessions.agg(*means, sketch.alias("median_duration_min")).select(*columns)
    lasted = sessions.select(minutes_to_micros("session_duration_min").alias("micros"))
    median = exact_median(lasted, "micros").select(
        micros_to_minutes(F.col("median")).alias("median_duration_min")
    )
    # Both sides are single rows; uniting and folding them avoids a join.
    return (
        sessions.agg(*means)
        .unionByName(median, allowMissingColumns=True)
        .agg(*[F.max(name).alias(name) for name in columns])
    )


def session_sample(sessions: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """`size` sessions, the same ones on every run: the first in md5 order.

    The md5 spreads the sessions evenly over 65,536 buckets. Counting them tells
    which buckets hold the first `size` rows and how many rows to take of each, so
    only those buckets are ordered, each on its own, and no task gets all `size` rows.
    """
    # Without nulls the join below needs no filter, which would compute it once more.
    digest = F.coalesce(F.md5(F.col("user_session").cast("binary")), F.lit(""))
    keyed = sessions.withColumn("_digest", digest)
    bucket = F.substring("_digest", 1, BUCKET_DIGITS)
    sizes = keyed.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        sizes.withColumn("_ahead", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .filter(F.col("_ahead") < size)
        .select("_bucket", "_ahead")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", "user_session"))
    return (
        keyed.withColumn("_bucket", bucket)
        .join(F.broadcast(needed), "_bucket")
        .withColumn("_place", place)
        .filter(F.col("_ahead") + F.col("_place") <= size)
        .select(*sessions.columns)
    )
