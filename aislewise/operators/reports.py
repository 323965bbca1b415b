"""Report views over result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_rows(result: DataFrame, *order: Column | str, rows: int = 10) -> DataFrame:
    """First rows of a result in the given order."""
    return result.orderBy(*order).limit(rows)


def funnel_by_rate(funnel: DataFrame, rows: int = 5) -> DataFrame:
    """Categories with the highest purchase rate; those without views come last."""
    return (
        funnel.orderBy(F.desc_nulls_last("purchase_rate"), "top_category")
        .limit(rows)
        .select("top_category", "view", "cart", "purchase", "purchase_rate", "cart_rate")
    )


def funnel_steps(funnel: DataFrame, rows: int = 5) -> DataFrame:
    """The most viewed categories with one row per funnel step."""
    return top_rows(funnel, F.desc("view"), F.col("top_category"), rows=rows).unpivot(
        ["top_category"], ["view", "cart", "purchase"], "Step", "Count"
    )


def hourly_histogram(
    hourly: DataFrame, event_type: str = "purchase", unit: int = 50_000
) -> DataFrame:
    """Events of one type per hour with a bar of one `#` for each full unit."""
    marks = F.floor(F.col("count") / F.lit(unit)).cast("int")
    return (
        hourly.filter(F.col("event_type") == event_type)
        .select("hour", "count", F.repeat(F.lit("#"), marks).alias("bar"))
        .orderBy("hour")
    )
