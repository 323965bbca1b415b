"""The whole job: CSV files in, result tables out."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aislewise.operators import rank_products, require_rows
from aislewise.plans.analysis import FROM_EVENTS, analyse
from aislewise.plans.incremental import live_events, live_rejects, sync
from aislewise.plans.ingest import events_folder, ingest, ingest_report, quality_row
from aislewise.plans.rollup import follow_sessions, rollup_sessions, rollup_summary
from aislewise.schema import BLOCK_BYTES, SAMPLE_BLOCKS
from aislewise.session import apply_plan, plan_aggregation, size_shuffles
from aislewise.sinks import write_result
from aislewise.sources import load_rejects
from aislewise.sources.files import Paths, list_files

OUTCOME = "skipped boolean, lines_read long, lines_rejected long, rows_written long"
SYNCED = (
    "files_added long, files_removed long, files_kept long, lines_read long, rows_written long, "
    "lines_rejected long"
)
#: Bytes of a session's combined row in a shuffle: key, two times, count and sum.
SESSION_BYTES = 96


def run(
    spark: SparkSession,
    inputs: Paths,
    output: str,
    pattern: str | None = None,
    sample: bool = False,
    compact: bool = False,
    rejects: bool = False,
    multiline: bool = False,
    pack: bool = False,
) -> dict[str, str]:
    """Ingest unless already done, then run all analyses; returns the result paths.

    The splits of the ingest are sized by the input; the shuffles of the analyses by the bytes stored, the
    rows and the number of sessions that the ingest counted. `ingest_outcome` is a table of one row: whether
    the ingest was skipped, and the lines read and rejected and the rows written if not. `quality_report` is what
    the ingest counted of the well-formed rows. With `rejects` the malformed lines are
    stored as well, as (source_file, line), by the same pass.
    """
    size_shuffles(spark, inputs, pattern, SAMPLE_BLOCKS * BLOCK_BYTES if sample else None)
    target = f"{output}/validated"
    outcome = ingest(spark, inputs, target, pattern, sample, compact, rejects, multiline, pack)
    validated = events_folder(target, rejects)
    paths = {name: f"{output}/{name}" for name in ("ingest_outcome", "quality_report")}
    write_result(spark.createDataFrame([tuple(outcome)], OUTCOME), paths["ingest_outcome"])
    write_result(quality_row(spark, target), paths["quality_report"])
    if rejects:
        paths["rejects"] = f"{output}/rejects"
        write_result(load_rejects(spark, target), paths["rejects"])
    _size_analyses(spark, target, validated)
    return paths | analyse(spark, validated, f"{output}/results")


def _size_analyses(spark: SparkSession, target: str, validated: str) -> None:
    """The aggregation by session and event type is the largest shuffle of the analyses."""
    counted = ingest_report(spark, target)
    stored = list_files(spark, validated, "*.parquet").agg(F.sum("length")).first()[0] or 0
    groups = counted["sessions"] * 2
    apply_plan(spark, plan_aggregation(stored, counted["written"], groups, SESSION_BYTES))


def follow(
    spark: SparkSession,
    inputs: Paths,
    output: str,
    pattern: str | None = None,
    multiline: bool = False,
) -> dict[str, str]:
    """The job for a folder that changes: only new files are read, sessions are merged into the rollup.

    Results are those of run over the present files; the session statistics come from the
    rollup, and their summary from its sketches, so its median is approximate.
    """
    size_shuffles(spark, inputs, pattern)
    target, rollup = f"{output}/followed", f"{output}/sessions"
    outcome = sync(spark, inputs, target, pattern, multiline)
    follow_sessions(spark, target, rollup)
    events = live_events(spark, target)
    require_rows(events)
    built = {
        name: build(events) for name, build in FROM_EVENTS.items() if name != "session_partials"
    } | {
        "sync_outcome": spark.createDataFrame([tuple(outcome)], SYNCED),
        "session_stats": rollup_sessions(spark, rollup),
        "session_summary": rollup_summary(spark, rollup),
        "rejects": live_rejects(spark, target),
    }
    paths = {name: f"{output}/results/{name}" for name in (*built, "product_rank")}
    for name, result in built.items():
        write_result(result, paths[name])
    write_result(rank_products(spark.read.parquet(paths["product_sales"])), paths["product_rank"])
    return paths
