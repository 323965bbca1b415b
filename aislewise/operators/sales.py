"""Purchase totals by any key, and the category and brand reports from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import top_category


def cents(amount: Column | str) -> Column:
    """An amount in whole cents: sums of the same prices compare equal in any order of adding."""
    return F.floor((F.col(amount) if isinstance(amount, str) else amount) * 100 + 0.5)


def sales_by(events: DataFrame, *keys: Column | str) -> DataFrame:
    """Revenue and number of purchases per key."""
    return (
        events.filter(F.col("event_type") == "purchase")
        .groupBy(*keys)
        .agg(F.sum("price").alias("total_revenue"), F.count("*").alias("num_purchases"))
    )


def revenue_by_category(events: DataFrame) -> DataFrame:
    """Revenue, number and mean price of purchases per top category, best first."""
    return (
        sales_by(events, top_category().alias("top_category"))
        .withColumn("avg_price", F.col("total_revenue") / F.col("num_purchases"))
        .orderBy(cents("total_revenue").desc(), "top_category")
    )


def top_brands(events: DataFrame, top_n: int = 20) -> DataFrame:
    """The brands with the highest purchase revenue; equal revenue goes by name."""
    return (
        sales_by(events.filter(F.col("brand").isNotNull()), "brand")
        .orderBy(cents("total_revenue").desc(), "brand")
        .limit(top_n)
    )


def product_sales(events: DataFrame) -> DataFrame:
    """Revenue, to the cent, and number of purchases per product."""
    return sales_by(events, top_category().alias("top_category"), "product_id").withColumn(
        "total_revenue", F.round("total_revenue", 2)
    )
