"""Session statistics that stand from month to month."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import micros_between, micros_to_minutes
from aislewise.operators import merge_session_partials, session_stats
from aislewise.plans.incremental import events_of, live_events
from aislewise.plans.incremental import ledger_of as files_ledger
from aislewise.plans.ledger import Ledger
from aislewise.workspace import stage

BUCKETS = 1024
# Where the number of buckets is chosen by the first events: their rows per bucket, which leaves room for
# forty times as many, and the fewest buckets.
ROWS_PER_BUCKET = 250_000
LEAST_BUCKETS = 16
#: Size of the quantile sketches: ranks are off by about 1 in 1,500.
SKETCH_SIZE = 4096
SESSIONS = (
    "user_session string, session_start timestamp_ntz, session_end timestamp_ntz, num_events long, "
    "total_spend double"
)
# A row is a bucket, or a source of events that is merged (with its number of rows).
LIVE = (
    "bucket int, version string, buckets int, num_sessions long, num_events long, total_spend double, "
    "durations binary, source string, rows long"
)


class RollupOutcome(NamedTuple):
    rewritten: int
    untouched: int


def ledger_of(spark: SparkSession, folder: str) -> Ledger:
    return Ledger(spark, f"{folder}/live", LIVE)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_session"), F.lit(buckets)).cast("int")


def update_rollup(
    spark: SparkSession,
    folder: str,
    partials: DataFrame,
    buckets: int = BUCKETS,
    replace: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> RollupOutcome:
    """Merge session partials into the rollup below `folder`.

    The rollup has one row per session, in buckets by a hash of the session. Only buckets that a session
    of `partials` falls into are read and written, as a new version of these; the others keep their files.
    The ledger names the live version of each bucket and holds the bucket's totals and a mergeable
    sketch of its durations, so a summary reads no session.

    `buckets` counts for the first update; later ones keep to it. A bucket is written by one task, so
    choose them by the sessions in the end: two million sessions of a bucket take about 100 MB. Buckets
    listed in `replace` (column bucket) are taken from `partials` alone, for sessions that lost events.
    `sources` (source, rows) is what the rollup holds from then on, if its batches have names.
    An interrupted update leaves the former state.
    """
    ledger = ledger_of(spark, folder)
    known = stage(_latest(spark, folder), "live")
    live = known.where("bucket is not null")
    buckets = rollup_buckets(spark, folder) or buckets
    measures = [f.split()[0] for f in SESSIONS.split(", ")]
    fresh = stage(partials.select(*measures).withColumn("bucket", bucket_of(buckets)), "fresh")
    touched = fresh.select("bucket").distinct()
    if replace is not None:
        touched = touched.unionByName(replace.select("bucket")).distinct()
    # At most `buckets` rows.
    touched = stage(touched, "touched")
    old = live.join(touched, "bucket", "left_semi")
    if replace is not None:
        old = old.join(replace.select("bucket"), "bucket", "left_anti")
    united = fresh.unionByName(_stored(spark, folder, old))
    version = uuid.uuid4().hex
    root = f"{folder}/sessions/version={version}"
    merged = merge_session_partials(united.repartition("bucket"), "bucket").drop("session_duration_min")
    merged.write.partitionBy("bucket").parquet(root)

    stored = spark.read.schema(f"{SESSIONS}, bucket int").parquet(root)
    minutes = micros_to_minutes(micros_between("session_start", "session_end"))
    totals = stored.groupBy("bucket").agg(
        F.lit(version).alias("version"),
        F.lit(buckets).alias("buckets"),
        F.count("*").alias("num_sessions"),
        F.sum("num_events").alias("num_events"),
        F.sum("total_spend").alias("total_spend"),
        F.kll_sketch_agg_double(minutes, F.lit(SKETCH_SIZE)).alias("durations"),
    )
    untouched = live.join(touched, "bucket", "left_anti")
    merged = known.where("bucket is null").select("source", "rows") if sources is None else sources
    for more in (totals, merged.select("source", "rows")):
        untouched = untouched.unionByName(more, allowMissingColumns=True)
    ledger.publish(stage(untouched, "live"))
    untouched = live.join(touched, "bucket", "left_anti")
    return RollupOutcome(touched.count(), untouched.count())


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    live = ledger_of(spark, folder).latest()
    return spark.createDataFrame([], LIVE) if live is None else live


def rollup_buckets(spark: SparkSession, folder: str) -> int | None:
    """The number of buckets that the rollup was begun with."""
    return _latest(spark, folder).agg(F.max("buckets")).first()[0]


def _stored(spark: SparkSession, folder: str, live: DataFrame) -> DataFrame:
    """Sessions of the given buckets with their bucket."""
    schema = f"{SESSIONS}, bucket int"
    root = f"{folder}/sessions"
    # One path per live bucket; their number is bounded by `buckets`.
    rows = live.select("version", "bucket").orderBy("bucket").collect()
    if not rows:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/version={row.version}/bucket={row.bucket}" for row in rows]
    reader = spark.read.option("basePath", root).schema(f"{schema}, version string")
    return reader.parquet(*paths).drop("version")


def rollup_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """session_stats of everything that was merged."""
    live = _latest(spark, folder).where("bucket is not null")
    sessions = _stored(spark, folder, live).drop("bucket")
    minutes = micros_to_minutes(micros_between("session_start", "session_end"))
    return sessions.withColumn("session_duration_min", minutes)


def rollup_summary(spark: SparkSession, folder: str) -> DataFrame:
    """session_summary from the totals and sketches of the buckets; the median is approximate."""
    return (
        _latest(spark, folder).where("bucket is not null")
        .agg(
            F.coalesce(F.sum("num_sessions"), F.lit(0)).alias("num_sessions"),
            F.sum("num_events").alias("events"),
            F.sum("total_spend").alias("spend"),
            F.kll_merge_agg_double("durations").alias("durations"),
        )
        .select(
            "num_sessions",
            F.try_divide("events", "num_sessions").alias("avg_events"),
            F.when(F.col("num_sessions") > 0, F.kll_sketch_get_quantile_double("durations", F.lit(0.5))).alias(
                "median_duration_min"
            ),
            F.try_divide("spend", "num_sessions").alias("avg_spend"),
        )
    )


def follow_sessions(
    spark: SparkSession, target: str, folder: str, buckets: int | None = None
) -> RollupOutcome | None:
    """Bring the rollup in line with the files that sync has stored below `target`; None if it is.

    New files are merged by their own sessions. Where files have gone, the buckets of their sessions
    are computed anew from what the present files have for these buckets; that alone reads events
    of files which were merged before. Without `buckets` the first events decide on their number.
    """
    files = stage(files_ledger(spark, target).latest().select("source", "rows"), "sources")
    merged = _latest(spark, folder).where("bucket is null").select("source", "rows")
    fresh = files.join(merged.select("source"), "source", "left_anti")
    gone = stage(merged.join(files.select("source"), "source", "left_anti"), "gone")
    if fresh.isEmpty() and gone.isEmpty():
        return None
    partials = session_stats(live_events(spark, target, fresh))
    rows = files.agg(F.sum("rows")).first()[0] or 0
    number = rollup_buckets(spark, folder) or buckets or max(LEAST_BUCKETS, rows // ROWS_PER_BUCKET)
    if gone.isEmpty():
        return update_rollup(spark, folder, partials, number, sources=files)
    bucket = bucket_of(number).alias("bucket")
    lost = stage(events_of(spark, target, gone).select(bucket).distinct(), "lost")
    present = live_events(spark, target).withColumn("bucket", bucket).join(lost, "bucket", "left_semi")
    again = session_stats(present)
    others = partials.withColumn("bucket", bucket).join(lost, "bucket", "left_anti").drop("bucket")
    return update_rollup(spark, folder, again.unionByName(others), number, replace=lost, sources=files)
