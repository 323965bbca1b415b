"""Ingest that follows a changing set of files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import utc_without_zone
from aislewise.operators import compare_schema
from aislewise.plans.ledger import Ledger
from aislewise.schema import CORRUPT, RAW
from aislewise.sinks.parquet_sink import BAD, GOOD, grade_lines, write_graded
from aislewise.sources.csv_events import parse_csv
from aislewise.sources.files import Paths, list_files, literal
from aislewise.workspace import stage

FILES = "path string, uri string, length long, modified long, source string, rows long, rejects long"


class SyncOutcome(NamedTuple):
    files_added: int
    files_removed: int
    files_kept: int
    lines_read: int
    rows_written: int
    lines_rejected: int


def ledger_of(spark: SparkSession, target: str) -> Ledger:
    return Ledger(spark, f"{target}/files", FILES)


def sync(
    spark: SparkSession,
    inputs: Paths,
    target: str,
    pattern: str | None = None,
    multiline: bool = False,
) -> SyncOutcome:
    """Bring the events below `target` in line with the files of `inputs`, reading new files only.

    The listing is compared with the ledger of files by path, length and time. The events of a
    file lie in partitions of its own, so new files are added beside the others, and those
    that are gone or changed only lose their place in the ledger. Their partitions stay on disk, unread.
    Equal to an ingest of the present files, whatever came before. Files without a line count as known.

    An interrupted run changes nothing that readers see; the next one writes the same partitions anew.
    A file that was replaced by one of equal length and time is taken for the same.
    """
    ledger = ledger_of(spark, target)
    listed = stage(list_files(spark, inputs, pattern), "listing")
    if not listed.groupBy("source").count().where("count > 1").isEmpty():
        raise ValueError("a file is listed twice, or two files have one source id")
    known = ledger.latest()
    if known is None:
        known = spark.createDataFrame([], FILES)
    added = listed.join(known.select("source"), "source", "left_anti")
    kept = known.join(listed.select("source"), "source", "left_semi")
    # Paths are what the listing of a scan holds in the driver anyway.
    fresh = added.select("path", "source").orderBy("path").collect()
    n_kept = kept.count()
    n_removed = known.count() - n_kept
    lines_read = 0
    written = spark.createDataFrame([], "source string, rows long, rejects long")
    if fresh:
        lines = Observation()
        parsed = parse_csv(spark, [literal(f.path) for f in fresh], None, multiline, source=True)
        parsed = parsed.observe(lines, F.count("*").alias("read"))
        compare_schema(parsed.drop(CORRUPT, "source", "source_file")).require()
        graded = grade_lines(parsed.select("source_file", "source", CORRUPT, *RAW.names))
        write_graded(graded, f"{target}/events", "source")
        lines_read = lines.get["read"]
        written = _written(spark, target, added)
    if fresh or n_removed:
        counted = added.join(written, "source", "left").na.fill(0, ["rows", "rejects"])
        # Written once: a second look at the partitions could see those of another run.
        ledger.publish(stage(kept.unionByName(counted), "files"))
    sums = written.agg(F.sum("rows").alias("rows"), F.sum("rejects").alias("rejects")).first()
    return SyncOutcome(
        len(fresh), n_removed, n_kept, lines_read, sums.rows or 0, sums.rejects or 0
    )


def _written(spark: SparkSession, target: str, added: DataFrame) -> DataFrame:
    """Rows and rejects of each new source, from the footers of what was written."""
    if not _exists(spark, f"{target}/events"):
        return spark.createDataFrame([], "source string, rows long, rejects long")
    stored = spark.read.schema("status string, source string").parquet(f"{target}/events")
    counts = stored.groupBy("source").agg(
        F.count_if(F.col("status") == GOOD).alias("rows"),
        F.count_if(F.col("status") == BAD).alias("rejects"),
    )
    return stage(counts.join(added.select("source"), "source", "left_semi"), "written")


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _read(spark: SparkSession, target: str, status: str, sources: DataFrame, schema: str) -> DataFrame:
    """What the partitions of the given sources hold."""
    root = f"{target}/events/status={status}"
    paths = [f"{root}/source={row.source}" for row in sources.select("source").orderBy("source").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root).schema(f"{schema}, source string")
    return reader.parquet(*paths).drop("source")


def _live(spark: SparkSession, target: str) -> DataFrame:
    rows = ledger_of(spark, target).latest()
    return spark.createDataFrame([], FILES) if rows is None else rows


def events_of(spark: SparkSession, target: str, sources: DataFrame) -> DataFrame:
    """The events of the given sources (source, rows), named by the ledger or no longer so."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW)
    events = _read(spark, target, GOOD, sources.where("rows > 0"), schema)
    return utc_without_zone(events).select(*RAW.names)


def live_events(spark: SparkSession, target: str, sources: DataFrame | None = None) -> DataFrame:
    """The events of all files that the ledger names, or of those whose ids `sources` holds."""
    rows = _live(spark, target)
    if sources is not None:
        rows = rows.join(sources.select("source"), "source", "left_semi")
    return events_of(spark, target, rows)


def live_rejects(spark: SparkSession, target: str) -> DataFrame:
    """The malformed lines of all files that the ledger names, as (source_file, line)."""
    sources = _live(spark, target).where("rejects > 0")
    return _read(spark, target, BAD, sources, "source_file string, line string")
