"""Exact median without bringing the values together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# A non-negative long is read as a leading part and two digits of 16 bits. In
# microseconds the leading part has 2**16 values for each nine years it spans.
DIGIT_BITS = 16
DIGIT_SHIFTS = (32, 16, 0)
DIGIT_MASK = (1 << DIGIT_BITS) - 1


def exact_median(values: DataFrame, column: str) -> DataFrame:
    """One row `median` (double): mean of the middle one or two values; null if none.

    `column` holds longs of zero or more; nulls are ignored. The median is found
    digit by digit: count the values per leading part, see in which one the middle
    ranks fall, and go on with the values that share it. Each count is combined
    before its shuffle and has one row per digit, so neither the number of values
    nor many equal ones burden a single task.
    """
    known = values.select(F.col(column).cast("long").alias("_value")).filter(
        F.col("_value").isNotNull()
    )
    counts = known.groupBy(F.shiftright("_value", DIGIT_SHIFTS[0]).alias("_digit")).agg(
        F.count("*").alias("_rows")
    )
    total = F.sum("_rows").over(Window.partitionBy())
    ranked = counts.withColumn("_total", total).withColumns(
        {
            "_upto": F.sum("_rows").over(Window.orderBy("_digit")),
            "_low": F.expr("(_total - 1) div 2"),
            "_high": F.expr("_total div 2"),
        }
    )
    found = _holding_ranks(ranked, F.col("_digit"))

    for shift in DIGIT_SHIFTS[1:]:
        prefix = F.shiftright("_value", shift + DIGIT_BITS)
        digit = F.shiftright("_value", shift).bitwiseAND(F.lit(DIGIT_MASK))
        # `found` has one row, or two where the middle ranks have parted.
        counts = (
            known.select(prefix.alias("_prefix"), digit.alias("_digit"))
            .join(F.broadcast(found), "_prefix")
            .groupBy("_prefix", "_low", "_high", "_digit")
            .agg(F.count("*").alias("_rows"))
        )
        upto = F.sum("_rows").over(Window.partitionBy("_prefix").orderBy("_digit"))
        found = _holding_ranks(
            counts.withColumn("_upto", upto),
            F.shiftleft("_prefix", DIGIT_BITS) + F.col("_digit"),
        )
    return found.agg(F.avg("_prefix").alias("median"))


def _holding_ranks(running: DataFrame, prefix: Column) -> DataFrame:
    """Digits that hold the lower or the higher middle rank, counted within the digit.

    A digit that holds one of them only carries it on as both.
    """
    before = F.col("_upto") - F.col("_rows")

    def inside(rank: str) -> Column:
        return (F.col(rank) >= before) & (F.col(rank) < F.col("_upto"))

    low = F.when(inside("_low"), F.col("_low")).otherwise(F.col("_high")) - before
    high = F.when(inside("_high"), F.col("_high")).otherwise(F.col("_low")) - before
    return running.filter(inside("_low") | inside("_high")).select(
        prefix.alias("_prefix"), low.alias("_low"), high.alias("_high")
    )
