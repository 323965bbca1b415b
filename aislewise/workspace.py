"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="aislewise-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under spark.checkpoint.dir.

    Only a local master may run without that setting; it then gets a folder of
    its own. A cluster has to name a folder that every executor can reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df once and hand back the stored table.

    For a result that several later passes read: they then scan only the columns
    they need, and a lost executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
