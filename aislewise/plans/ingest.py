"""CSV to validated Parquet, done once."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aislewise.operators import cleaning_rules, clean_events, compare_schema, quality_measures
from aislewise.schema import CORRUPT
from aislewise.sinks import write_validated
from aislewise.sinks.parquet_sink import GOOD, grade_lines, pack_types, write_graded
from aislewise.sources.csv_events import parse_csv, parse_csv_sample, well_formed
from aislewise.sources.files import Paths, list_files, roots

# The underscore hides these from a scan of the folder they lie in.
MARKER = "_ingest_mode"
REPORT = "_ingest_report"


class IngestOutcome(NamedTuple):
    skipped: bool
    lines_read: int | None = None
    lines_rejected: int | None = None
    rows_written: int | None = None


def ingest(
    spark: SparkSession,
    inputs: Paths,
    target: str,
    pattern: str | None = None,
    sample: bool = False,
    compact: bool = False,
    rejects: bool = False,
    multiline: bool = False,
    pack: bool = False,
) -> IngestOutcome:
    """Parse, check, clean and write the inputs in one pass over them.

    Skipped when target already holds events of the same mode and the same inputs: their
    names and pattern, and the path, length and time of each file. The marker that says so is written
    last and goes away with an overwrite, so an interrupted run is done again.

    With `rejects` the same pass writes the malformed lines too: the events are then below
    `status=good` and the lines below `status=bad` of target (events_folder, load_rejects). The pass also
    counts what quality_report would count of the well-formed rows (ingest_report). With `pack` event types
    in many small files are packed afterwards (pack_types).
    """
    state = input_state(spark, inputs, pattern, rejects, multiline)
    if _holds_events(spark, target) and _recorded(spark, target) == (sample, state):
        return IngestOutcome(skipped=True)

    if sample:
        parsed = parse_csv_sample(spark, inputs, pattern)
    else:
        parsed = parse_csv(spark, inputs, pattern, multiline)
    raw = well_formed(parsed)
    compare_schema(raw).require()
    seen = Observation()
    good = F.col(CORRUPT).isNull()
    kept = good
    for rule in cleaning_rules(raw):
        kept = kept & rule
    parsed = parsed.observe(
        seen,
        F.count("*").alias("read"),
        F.count_if(~good).alias("rejected"),
        F.count_if(kept).alias("written"),
        F.approx_count_distinct(F.when(kept, F.col("user_session"))).alias("sessions"),
        *quality_measures(raw, good),
    )
    if rejects:
        write_graded(grade_lines(parsed), target, replace_all=True)
    else:
        write_validated(clean_events(well_formed(parsed)), target, overwrite=True, compact=compact)
    if pack:
        pack_types(spark, events_folder(target, rejects))
    counts = seen.get
    _record_report(spark, target, counts)
    record_mode(spark, target, sample, state)
    return IngestOutcome(
        skipped=False,
        lines_read=counts["read"],
        lines_rejected=counts["rejected"],
        rows_written=counts["written"],
    )


def events_folder(target: str, rejects: bool) -> str:
    """Where ingest puts the events."""
    return f"{target}/status={GOOD}" if rejects else target


def _record_report(spark: SparkSession, target: str, counts: dict[str, int]) -> None:
    row = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])
    row.coalesce(1).write.mode("overwrite").json(f"{target}/{REPORT}")


def ingest_report(spark: SparkSession, target: str) -> dict[str, int]:
    """What the last ingest counted: lines read and rejected, rows written, about how many sessions
    they have, and the columns of quality_report over the well-formed rows."""
    return spark.read.json(f"{target}/{REPORT}").first().asDict()


def quality_row(spark: SparkSession, target: str) -> DataFrame:
    """quality_report of the well-formed rows of the last ingest, as it was counted then."""
    counts = ingest_report(spark, target)
    names = ["total_rows", "invalid_events", "negative_prices", *[c for c in counts if c.startswith("null_")]]
    return spark.range(1).select(*[F.lit(counts[c]).cast("long").alias(c) for c in names])


def input_state(
    spark: SparkSession,
    inputs: Paths,
    pattern: str | None = None,
    rejects: bool = False,
    multiline: bool = False,
) -> str:
    """What tells these inputs from others, from their listing; their content is not read.

    The sum over the files does not depend on their order, and changes with the path, length or
    time of any of them.
    """
    one = F.xxhash64("path", "length", "modified").cast("decimal(38, 0)")
    seen = list_files(spark, inputs, pattern).agg(F.count("*"), F.sum("length"), F.sum(one)).first()
    modes = [name for name, on in (("rejects", rejects), ("multiline", multiline)) if on]
    return json.dumps([roots(inputs), pattern, modes, *map(str, seen)])


def _holds_events(spark: SparkSession, target: str) -> bool:
    try:
        return not spark.read.schema("price double").parquet(target).isEmpty()
    except AnalysisException:
        return False


def _recorded(spark: SparkSession, target: str) -> tuple[bool, str | None] | None:
    """Mode and inputs of the last complete ingest; None if there is none or it is unreadable."""
    try:
        row = spark.read.schema("sample boolean, inputs string").json(f"{target}/{MARKER}").first()
    except AnalysisException:
        return None
    return (row.sample, row.inputs) if row else None


def record_mode(spark: SparkSession, target: str, sample: bool, state: str | None = None) -> None:
    mode = spark.range(1).select(F.lit(sample).alias("sample"), F.lit(state).alias("inputs"))
    mode.coalesce(1).write.mode("overwrite").json(f"{target}/{MARKER}")
