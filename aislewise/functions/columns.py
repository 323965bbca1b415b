"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.schema import EVENT_TYPES

MICROS_PER_MINUTE = 60_000_000.0


def top_category(code: str = "category_code") -> Column:
    """First step of a dotted category path, `unknown` where there is no path."""
    return F.coalesce(F.substring_index(code, ".", 1), F.lit("unknown"))


def is_event_type(name: str = "event_type") -> Column:
    """True for the four event types and false for all else, null included."""
    return F.coalesce(F.col(name).isin(*EVENT_TYPES), F.lit(False))


def has_text(name: str) -> Column:
    """True when the text holds a character other than white space of any script."""
    return F.col(name).rlike(r"(?U)[^\s\x1c-\x1f]")


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def utc_without_zone(df: DataFrame, name: str = "event_time") -> DataFrame:
    """Turn a zoned timestamp column into a zone-less one holding UTC.

    Counting from the epoch keeps the session zone out of it; a cast would go by
    its wall clock, which is ambiguous for an hour each year in many zones.
    """
    if not isinstance(df.schema[name].dataType, T.TimestampType):
        return df
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    return df.withColumn(name, F.timestamp_add("MICROSECOND", F.unix_micros(name), epoch))


def micros_between(start: str, end: str) -> Column:
    """Microseconds from one zone-less time to another.

    By way of an interval: timestamp_diff would read both in the session zone,
    where some wall clock times do not exist.
    """
    seconds = (F.col(end) - F.col(start)).cast("interval second").cast("decimal(18, 6)")
    return (seconds * F.lit(1_000_000)).cast("long")


def micros_to_minutes(micros: Column) -> Column:
    return micros / F.lit(MICROS_PER_MINUTE)


def minutes_to_micros(minutes: str) -> Column:
    """Inverse of micros_to_minutes; exact below 2**51 microseconds (71 years)."""
    return F.floor(F.col(minutes) * F.lit(MICROS_PER_MINUTE) + F.lit(0.5))
