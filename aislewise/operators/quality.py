"""Schema checks, quality counts and cleaning."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions import has_text, is_event_type, missing, utc_without_zone
from aislewise.schema import EVENT_TYPES, KEY_COLUMNS, RAW


class SchemaMismatch(RuntimeError):
    """Expected columns are missing."""


class SchemaComparison(NamedTuple):
    valid: bool
    missing: list[str]
    extra: list[str]
    mistyped: list[str]

    def require(self) -> None:
        if not self.valid:
            raise SchemaMismatch(f"missing columns: {', '.join(self.missing)}")


def compare_schema(df: DataFrame) -> SchemaComparison:
    """Columns of df against the event schema; reads no data.

    As valid counts every table that has all the columns. A column of another
    type is listed too; a zoned time is no such case, cleaning converts it.
    """
    expected = {field.name: field.dataType for field in RAW}
    actual = {field.name: field.dataType for field in df.schema}
    absent = sorted(expected.keys() - actual.keys())
    zoned = isinstance(actual.get("event_time"), T.TimestampType)
    return SchemaComparison(
        valid=not absent,
        missing=absent,
        extra=sorted(actual.keys() - expected.keys()),
        mistyped=sorted(
            f"{name} {actual[name].simpleString()}"
            for name in expected.keys() & actual.keys()
            if actual[name] != expected[name] and not (name == "event_time" and zoned)
        ),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """The comparison as one row, with the number of rows it speaks for."""
    found = compare_schema(df)
    return df.agg(F.count("*").alias("total_rows")).select(
        F.lit(found.valid).alias("valid"),
        F.lit(",".join(found.missing)).alias("missing"),
        F.lit(",".join(found.extra)).alias("extra"),
        F.lit(",".join(found.mistyped)).alias("mistyped"),
        "total_rows",
    )


def verify_input(df: DataFrame, partition_column: str = "event_type") -> DataFrame:
    """One row: row count, schema text, partition column present, any rows at all."""
    return df.agg(F.count("*").alias("total_rows")).select(
        "total_rows",
        F.lit(df.schema.simpleString()).alias("schema_text"),
        F.lit(partition_column in df.columns).alias("has_partition_column"),
        (F.col("total_rows") > 0).alias("has_rows"),
    )


def require_rows(df: DataFrame) -> None:
    """Raise on an empty table; stops at the first row found."""
    if df.isEmpty():
        raise ValueError("the event table holds no rows")


def quality_report(df: DataFrame) -> DataFrame:
    """One row from one pass: rows, nulls per column, unknown types, negative prices."""
    return df.agg(*quality_measures(df))


def null_counts(df: DataFrame) -> DataFrame:
    """The null counts in long form: one row per column."""
    counts = df.agg(*[F.count_if(missing(df, name)).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def cleaning_rules(df: DataFrame) -> list[Column]:
    """What a row must fulfil, one condition each: a null test per column reaches a Parquet scan.

    The test for missing values also drops NaN prices, which would pass the comparison with zero.
    """
    return [
        *[~missing(df, name) for name in KEY_COLUMNS],
        F.col("event_type").isin(*EVENT_TYPES),
        F.col("price") >= 0,
        has_text("user_session"),
    ]


def clean_events(df: DataFrame) -> DataFrame:
    """Complete keys, known event type, price of zero or more, non-blank session, UTC time."""
    kept = df
    for rule in cleaning_rules(df):
        kept = kept.filter(rule)
    return utc_without_zone(kept)


def quality_measures(df: DataFrame, among: Column | None = None) -> list[Column]:
    """The aggregates of quality_report, over all rows or those for which `among` holds."""

    def counted(condition: Column) -> Column:
        return F.count_if(condition if among is None else among & condition)

    return [
        F.count("*").alias("total_rows") if among is None else F.count_if(among).alias("total_rows"),
        counted(~is_event_type()).alias("invalid_events"),
        counted(F.col("price") < 0).alias("negative_prices"),
        *[counted(missing(df, name)).alias(f"null_{name}") for name in df.columns],
    ]
