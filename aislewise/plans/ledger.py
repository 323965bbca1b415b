"""Which stored pieces of a table are valid, changed as a whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Ledger:
    """Versions of a small table below `folder`, of which the newest counts.

    A version is written to a folder of its own first; then one row of a log names it. So readers see the
    former version until the new one is complete, and a job that dies in between leaves no trace in
    what they see. Writers must not run at the same time.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str) -> None:
        self.spark, self.folder, self.schema = spark, folder, schema

    def latest(self) -> DataFrame | None:
        """Rows of the newest version; None before the first."""
        newest = self._newest()
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{newest.name}") if newest else None

    def publish(self, rows: DataFrame) -> None:
        newest = self._newest()
        name = f"version-{uuid.uuid4().hex}"
        rows.select(*self._columns()).write.parquet(f"{self.folder}/{name}")
        number = newest.number + 1 if newest else 0
        entry = self.spark.range(1).select(F.lit(number).alias("number"), F.lit(name).alias("name"))
        entry.coalesce(1).write.mode("append").json(f"{self.folder}/log")

    def _columns(self) -> list[str]:
        return [part.split()[0] for part in self.schema.split(",")]

    def _newest(self):
        log = self.spark.read.schema("number long, name string")
        try:
            return log.json(f"{self.folder}/log").orderBy(F.desc("number")).first()
        except AnalysisException:
            return None
