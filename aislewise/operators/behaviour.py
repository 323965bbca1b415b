"""Conversion funnel and activity by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.functions import top_category
from aislewise.schema import EVENT_TYPES


def conversion_funnel(events: DataFrame) -> DataFrame:
    """Events of each type per top category with cart and purchase rates per view.

    Conditional counts need one aggregation; a pivot would need two.
    """
    counts = [
        F.count_if(F.col("event_type") == event_type).alias(event_type)
        for event_type in EVENT_TYPES
    ]
    return (
        events.groupBy(top_category().alias("top_category"))
        .agg(*counts)
        .withColumns(
            {
                "cart_rate": F.try_divide("cart", "view"),
                "purchase_rate": F.try_divide("purchase", "view"),
            }
        )
        .orderBy(F.desc("view"), "top_category")
    )


def hourly_activity(events: DataFrame) -> DataFrame:
    """Events per hour of day (UTC) and type."""
    return (
        events.groupBy(F.hour("event_time").alias("hour"), "event_type")
        .agg(F.count("*").alias("count"))
        .orderBy("hour", "event_type")
    )
