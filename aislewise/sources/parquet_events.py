"""Validated events at rest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from aislewise.functions import utc_without_zone


def load_events(spark: SparkSession, path: str) -> DataFrame:
    """Parquet events partitioned by event_type.

    The physical schema is taken from the files because other writers store
    event_time as a zoned INT96 value; the result always holds zone-less UTC.
    """
    return utc_without_zone(spark.read.parquet(path))


def load_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Malformed lines as (source_file, line), where an ingest stored them; empty if there were none."""
    schema = "source_file string, line string"
    try:
        return spark.read.schema(schema).parquet(f"{path}/status=bad")
    except AnalysisException:
        return spark.createDataFrame([], schema)
