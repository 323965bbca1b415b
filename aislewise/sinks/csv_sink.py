"""CSV files in the shape the scan expects."""

from __future__ import annotations

from pyspark.sql import DataFrame

SECONDS = "yyyy-MM-dd HH:mm:ss 'UTC'"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"


def write_events_csv(
    df: DataFrame, path: str, time_format: str = SECONDS, mode: str = "errorifexists"
) -> None:
    """Events as CSV with a header; text keeps its blanks, null becomes an empty field."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", time_format)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
