"""Rank of products within their category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from aislewise.operators.sales import cents, product_sales

# Scores are ranked in blocks of 2**20 neighbouring values.
BLOCK_BITS = 20


def product_rank(
    events: DataFrame, measure: str = "total_revenue", top_n: int | None = None
) -> DataFrame:
    """SQL RANK of products within each top category by purchases, best first."""
    return rank_products(product_sales(events), measure, top_n)


def rank_products(
    sales: DataFrame, measure: str = "total_revenue", top_n: int | None = None
) -> DataFrame:
    """The rank for a table of product_sales, read more than once: best a stored one.

    `measure` is total_revenue or num_purchases. Revenue is compared in whole
    cents, so that products with equal sales share a rank. With `top_n` only the
    products up to that rank are kept, all of those that share it included.

    A plain RANK window would sort all products of a category in one task. Here
    ranks are worked out per distinct score and joined to the products.
    """
    if measure == "total_revenue":
        score = cents("total_revenue")
    elif measure == "num_purchases":
        score = F.col("num_purchases")
    else:
        raise ValueError(f"unknown measure {measure}")
    # Without nulls the joins need no filters, so that both uses of the scores below
    # are the same to Spark and share one shuffle.
    scored = sales.withColumns(
        {
            "_score": F.coalesce(score, F.lit(0)),
            "top_category": F.coalesce("top_category", F.lit("unknown")),
        }
    )
    ranks = _ranks(scored, top_n)
    return scored.join(ranks, ["top_category", "_score"]).select(
        "top_category", "product_id", "total_revenue", "num_purchases", "rank"
    )


def _ranks(scored: DataFrame, top_n: int | None) -> DataFrame:
    """Rank of each score, up to top_n: one plus the number of products ahead.

    These are the products in better blocks of scores and those with a better
    score in the same block. A window sees the blocks of a category or the
    distinct scores of a block, not the products. Blocks with top_n products or
    more ahead of them are left out before the second window.
    """
    block = F.shiftright("_score", BLOCK_BITS).alias("_block")
    scores = scored.groupBy("top_category", block, "_score").agg(F.count("*").alias("_products"))
    blocks = scores.groupBy("top_category", "_block").agg(F.sum("_products").alias("_products"))

    def ahead(window: WindowSpec) -> Column:
        better = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_products").over(better), F.lit(0))

    by_block = Window.partitionBy("top_category").orderBy(F.desc("_block"))
    in_block = Window.partitionBy("top_category", "_block").orderBy(F.desc("_score"))
    offsets = blocks.select("top_category", "_block", ahead(by_block).alias("_offset"))
    if top_n is not None:
        offsets = offsets.filter(F.col("_offset") < top_n)
    ranks = (
        scores.join(offsets, ["top_category", "_block"])
        .withColumn("_ahead", ahead(in_block))
        .select("top_category", "_score", (F.col("_offset") + F.col("_ahead") + 1).alias("rank"))
    )
    return ranks if top_n is None else ranks.filter(F.col("rank") <= top_n)
