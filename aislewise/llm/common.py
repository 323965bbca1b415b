"""Sampling, sizing and table access that several operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.workspace import stage

__all__ = ["bounded_batches", "fold", "hashed_sample", "read_table", "release_memory", "stage", "text_bytes"]

ARROW_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, most_bytes: int | None = None) -> None:
    """Bounds the rows and bytes of one Arrow batch, unless the session was given bounds.

    A Python worker then holds a few megabytes of text at a time however long
    the documents are; a document larger than that travels alone.
    """
    _ship_package(spark)
    given = spark.sparkContext.getConf()
    for key, value in ARROW_BATCH.items():
        if not given.contains(key):
            spark.conf.set(key, str(most_bytes) if most_bytes and key.endswith("maxBytesPerBatch") else value)


def release_memory() -> None:
    """Gives what earlier tasks of this worker process have freed back to the system.

    A process serves tasks of many stages one after another; without this it keeps the memory of the largest.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application.

    Workers import the functions they run. Where the package is neither installed on the executors nor
    among the submitted files, they get it from the driver by Spark's own means.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="aislewise-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(text: Column) -> Column:
    """Text length in UTF-8 bytes, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def hashed_sample(
    rows: DataFrame, size: int, key: Sequence[str], strata: Sequence[str] = ()
) -> DataFrame:
    """About `size` distinct rows of each stratum, the same ones on every run.

    Rows are taken by the hash of their `key` columns under a threshold that
    follows from the number of distinct keys, and rows of equal key count once, so many
    copies of one row can neither enlarge nor thin out the sample. No stratum is left empty.
    """
    hashed = F.xxhash64(*[F.col(c) for c in key])
    mark = F.pmod(hashed, F.lit(1 << 30))
    keys = rows.select(*strata, hashed.alias("hashed")).distinct()
    least = F.min(F.pmod("hashed", F.lit(1 << 30)))
    counts = keys.groupBy(*strata).agg(F.count("*").alias("count"), least.alias("least")).collect()
    share = F.lit(0)
    for row in counts:
        here = F.lit(True)
        for c in strata:
            here = here & F.col(c).eqNullSafe(F.lit(row[c]))
        bound = min(1 << 30, -(-size * (1 << 30) // max(1, row["count"])))
        bound = max(bound, (row["least"] or 0) + 1)
        share = F.when(here, F.lit(bound)).otherwise(share)
    others = [c for c in rows.columns if c not in key]
    drawn = rows.where(mark < share)
    if not others:
        return drawn.select(*key).distinct()
    return drawn.groupBy(*key).agg(*[F.first(c).alias(c) for c in others])
