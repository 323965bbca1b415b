"""Column expressions shared by the operators."""

from aislewise.functions.columns import (
    has_text,
    is_event_type,
    micros_between,
    micros_to_minutes,
    minutes_to_micros,
    missing,
    top_category,
    utc_without_zone,
)

__all__ = [
    "has_text",
    "is_event_type",
    "micros_between",
    "micros_to_minutes",
    "minutes_to_micros",
    "missing",
    "top_category",
    "utc_without_zone",
]
