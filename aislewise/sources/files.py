"""The files of an input and their header lines."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.schema import BLOCK_BYTES

Paths = str | Sequence[str]
BYTE_ORDER_MARK = "\ufeff"


class InputFile(NamedTuple):
    """`path` opens the file; `uri` is how a scan names it; `source` tells this state of it from others."""

    path: str
    uri: str
    length: int
    modified: int
    source: str


def roots(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def literal(path: str) -> str:
    """A path for a reader that expands patterns, standing for itself."""
    return re.sub(r"([\\{}\[\]*?^])", r"\\\1", path)


def source_id() -> Column:
    """Name of a file's state: another length or time is another source."""
    stated = ("file_path", "file_size", "file_modification_time")
    return F.lower(F.hex(F.xxhash64(*[F.col(f"_metadata.{c}") for c in stated])))


def list_files(spark: SparkSession, paths: Paths, pattern: str | None = None) -> DataFrame:
    """One row per file with the fields of InputFile, from the listing alone."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(roots(paths)).select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        "length",
        F.unix_micros("modificationTime").alias("modified"),
        source_id().alias("source"),
    )


def text_lines(spark: SparkSession, paths: Paths, pattern: str | None = None) -> DataFrame:
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(roots(paths))


def split_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def most_tasks(spark: SparkSession, length: int) -> int:
    """Tasks of a scan of `length` bytes whose splits are small: several splits then share a task."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-length // BLOCK_BYTES))


@contextlib.contextmanager
def split_at(spark: SparkSession, size: int, tasks: int | None = None) -> Iterator[None]:
    """Scans that run within begin their splits at multiples of `size`, packed for at most about `tasks` tasks.

    Otherwise Spark also takes smaller splits so that each core gets one. The splits of one file are packed in
    their order.
    """
    prefix = "spark.sql.files."
    chosen = {"maxPartitionBytes": str(size), "minPartitionNum": "1"}
    if tasks:
        chosen["maxPartitionNum"] = str(tasks)
    before = {key: spark.conf.get(prefix + key, None) for key in chosen}
    try:
        for key, value in chosen.items():
            spark.conf.set(prefix + key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(prefix + key)
            else:
                spark.conf.set(prefix + key, value)


def read_headers(
    spark: SparkSession, paths: Paths, pattern: str | None = None
) -> dict[str, str]:
    """The first line with content of each file, by uri; a file without one is absent.

    A task leaves off as soon as nothing more can follow: a split of full size is alone in its
    partition, so behind its first line there is no header of another file. Large files are
    thus opened but not read. Splits have a block at least, however small those of the session are.
    """
    full = max(split_bytes(spark), BLOCK_BYTES)
    placed = text_lines(spark, paths, pattern).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"),
        "value",
    ).where((F.col("start") == 0) | (F.col("size") >= full))
    found = placed.mapInArrow(_header_finder(full), "uri string, header string")
    with split_at(spark, full):
        return {row.uri: row.header.removeprefix(BYTE_ORDER_MARK) for row in found.collect()}


def _header_finder(full: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            fresh = []
            alone = False
            if seen.issuperset(batch.column(0).unique().to_pylist()) and batch.column(2)[0].as_py() < full:
                continue
            for uri, start, size, value in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if start == 0 and uri not in seen and value.strip():
                    seen.add(uri)
                    fresh.append((uri, value))
                if size >= full and (start > 0 or uri in seen):
                    alone = True
                    break
            if fresh:
                columns = [pa.array(list(c), pa.string()) for c in zip(*fresh)]
                yield pa.RecordBatch.from_arrays(columns, names=["uri", "header"])
            if alone:
                return

    return find
