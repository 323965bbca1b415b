"""CSV event files: scan, rejects, sample and discovery.

The files are read as text lines and each line is parsed with from_csv against
all columns. The CSV reader itself cannot be used to set malformed rows aside:
which rows it calls malformed depends on the columns a query happens to touch.
A quoted field may contain a line break where `multiline` says so; that costs a pass over the
text to count quotes. Each file has its columns in the order of its own header.
"""

from __future__ import annotations

import csv
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.schema import BLOCK_BYTES, CORRUPT, MONTHLY_FILES, RAW, SAMPLE_BLOCKS
from aislewise.sources.csv_records import quoted_records
from aislewise.sources.files import (
    BYTE_ORDER_MARK,
    Paths,
    list_files,
    literal,
    most_tasks,
    read_headers,
    source_id,
    split_at,
    split_bytes,
    text_lines,
)
from aislewise.workspace import stage

# Seconds are usual; a fraction and a missing zone are accepted too.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS][ 'UTC']"
PARSE_OPTIONS = {"timestampNTZFormat": TIME_FORMAT, "escape": '"'}


def discover_inputs(
    spark: SparkSession, folder: str, names: Sequence[str] = MONTHLY_FILES
) -> list[str]:
    """Paths of the named files that exist in folder, in the order of names."""
    try:
        listing = spark.read.text(folder, pathGlobFilter="{" + ",".join(names) + "}")
    except AnalysisException:
        return []
    found = {path.rsplit("/", 1)[-1]: path for path in listing.inputFiles()}
    return [found[name] for name in names if name in found]


def read_header(spark: SparkSession, paths: Paths, pattern: str | None = None) -> str | None:
    """Header line of the input, or None when there are no lines."""
    with split_at(spark, max(split_bytes(spark), BLOCK_BYTES)):
        first = (
            text_lines(spark, paths, pattern)
            .filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
            .select("value")
            .first()
        )
    return first.value.removeprefix(BYTE_ORDER_MARK) if first else None


def _column_list(header: str | None) -> str:
    """DDL for from_csv: known columns typed, others text, in file order."""
    names = next(csv.reader([header])) if header else RAW.names
    known = {field.name: field.dataType.simpleString() for field in RAW}
    quoted = ["`{}` {}".format(n.replace("`", "``"), known.get(n, "string")) for n in names]
    return ", ".join([*quoted, f"{CORRUPT} string"])


def _parse(lines: DataFrame, header: str | None) -> DataFrame:
    """The columns of `lines` but for value, those of the header, and the raw line if malformed.

    inline() keeps the filters that follow above the parser, so that every line
    is parsed once and always against all columns.
    """
    body = lines.filter(F.trim("value") != "")
    if header is not None:
        body = body.filter(F.ltrim("value", F.lit(BYTE_ORDER_MARK)) != header)
    record = F.from_csv("value", _column_list(header), PARSE_OPTIONS)
    named = [c for c in lines.columns if c != "value"]
    return body.select(*named, F.inline(F.array(record)))


def _lines(spark: SparkSession, paths: Paths, pattern: str | None, multiline: bool, source: bool) -> DataFrame:
    named = {"source_file": F.col("_metadata.file_name")}
    if source:
        named["source"] = source_id()
    lines = text_lines(spark, paths, pattern).withColumns(named)
    if not multiline:
        return lines
    tasks = None
    if split_bytes(spark) < BLOCK_BYTES:
        length = list_files(spark, paths, pattern).agg(F.sum("length")).first()[0] or 0
        tasks = most_tasks(spark, length)
    return quoted_records(lines, tasks=tasks)


def parse_csv(
    spark: SparkSession,
    paths: Paths,
    pattern: str | None = None,
    multiline: bool = False,
    source: bool = False,
) -> DataFrame:
    """All lines, good and malformed, with source_file and _corrupt_record.

    Files may differ in their headers: those of one header are one scan, and the scans are united by
    the names of columns; a column that a file lacks is null there. With `source` the
    state of the file goes along as a column of that name (sources.files.source_id).
    """
    headers = read_headers(spark, paths, pattern)
    if len(set(headers.values())) < 2:
        header = next(iter(headers.values()), None)
        return _parse(_lines(spark, paths, pattern, multiline, source), header)
    files: dict[str, list[str]] = {}
    for row in list_files(spark, paths, pattern).select("path", "uri").orderBy("uri").collect():
        if row.uri in headers:
            files.setdefault(headers[row.uri], []).append(literal(row.path))
    scans = [_parse(_lines(spark, f, None, multiline, source), header) for header, f in files.items()]
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "source_file")


def scan_csv(
    spark: SparkSession, paths: Paths, pattern: str | None = None, multiline: bool = False
) -> DataFrame:
    """Rows of one or many CSV files as one table; malformed lines are left out."""
    return well_formed(parse_csv(spark, paths, pattern, multiline))


def scan_rejects(
    spark: SparkSession, paths: Paths, pattern: str | None = None, multiline: bool = False
) -> DataFrame:
    """The malformed lines as (source_file, line)."""
    return (
        parse_csv(spark, paths, pattern, multiline)
        .filter(F.col(CORRUPT).isNotNull())
        .select("source_file", F.col(CORRUPT).alias("line"))
    )


def parse_csv_sample(
    spark: SparkSession,
    paths: Paths,
    pattern: str | None = None,
    blocks: int = SAMPLE_BLOCKS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """parse_csv over the first blocks of the input, each file by its own header.

    Files count in the order given, those of a folder by path. Rows belong to the block
    in which their line starts. The lines of a file that is cut are stored at once.
    """
    parts = []
    for file, length, n in _first_blocks(spark, paths, pattern, blocks, block_bytes):
        if n * block_bytes < length:
            lines = _head_lines(spark, literal(file), length, n * block_bytes, block_bytes)
        else:
            lines = text_lines(spark, literal(file)).withColumn("source_file", F.col("_metadata.file_name"))
        parts.append(_parse(lines, read_header(spark, literal(file))))
    if not parts:
        return parse_csv(spark, paths, pattern)
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _head_lines(spark: SparkSession, path: str, length: int, cut: int, block_bytes: int) -> DataFrame:
    """The lines that start in the first `cut` bytes of one file, stored."""
    placed = text_lines(spark, path).select(
        "value",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    head = placed.mapInArrow(_rows_before(cut), "value string, source_file string")
    # Small blocks are read many to a task.
    with split_at(spark, block_bytes, -(-length // BLOCK_BYTES)):
        return stage(head, "head-lines")


def _rows_before(cut: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of splits that start before `cut`. The splits of a task come in order, so it ends at the first other one."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = pc.less(batch.column(2), cut)
            yield batch.select([0, 1]).filter(before)
            if not pc.all(before).as_py():
                return

    return take


def _first_blocks(
    spark: SparkSession, paths: Paths, pattern: str | None, blocks: int, block_bytes: int
) -> list[tuple[str, int, int]]:
    """The files that hold the first blocks, their lengths, and how many of the blocks each holds.

    A file with content has a block at least, so `blocks` files are enough to look at.
    """
    found: list[tuple[str, int, int]] = []
    for root in [paths] if isinstance(paths, str) else paths:
        reader = spark.read.format("binaryFile")
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        files = reader.load(root).select("path", "length").where("length > 0")
        for file in files.orderBy("path").limit(blocks).collect():
            left = blocks - sum(n for *_, n in found)
            if left > 0:
                found.append((file.path, file.length, min(left, -(-file.length // block_bytes))))
    return found


def sample_csv(
    spark: SparkSession,
    paths: Paths,
    pattern: str | None = None,
    blocks: int = SAMPLE_BLOCKS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Well-formed rows in the first blocks of the input, for quick trials."""
    return well_formed(parse_csv_sample(spark, paths, pattern, blocks, block_bytes))
