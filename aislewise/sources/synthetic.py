"""Synthetic events: a pure function of a row id, so any id column can drive it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.sinks import write_events_csv

# Vocabularies and ranges (both ends included) of the columns.
TYPES = ("view", "cart", "purchase", "remove_from_cart")
BRANDS = ("samsung", "apple", "huawei", "lg", "sony", "unknown")
CATEGORIES = (
    "electronics.smartphone",
    "appliances.kitchen.refrigerators",
    "computers.notebook",
    "electronics.audio.headphone",
)
PRICE_CENTS = (1_000, 200_000)
PRODUCT_IDS = (1_000, 9_999_999)
USER_IDS = (100_000_000, 999_999_999)
FIRST_CATEGORY_ID = 2_000_000_000_000_000_000
DAYS = 30

# A draw is seed * multiplier modulo a prime, with the high bits folded onto the
# low ones. Both factors are below 2**31, so the product fits a long. The
# multipliers are published generators for this modulus (Park and Miller; Fishman
# and Moore).
MODULUS = 2_147_483_647
FOLD_BITS = 15
MULTIPLIERS = {
    "seed": 16_807,
    "event_time": 48_271,
    "event_type": 69_621,
    "product_id": 1_385_320_287,
    "category_high": 39_373,
    "category_low": 630_360_016,
    "category_code": 742_938_285,
    "brand": 950_706_376,
    "price": 1_226_874_159,
    "user_id": 62_089_911,
    "user_session": 1_343_714_438,
}
# Ids beyond the modulus are shifted on each wrap, so that they do not repeat, and
# seeds start far from one another.
WRAP_SHIFT = 7_919
SEED_SHIFT = 1_000_003
# 2**31 times this stays just below 10**18, the width of the category id range.
CATEGORY_STEP = 465_661_287

START = "2019-10-01 00:00:00"
BYTES_PER_LINE = 134


def _seed(number: Column, seed: int) -> Column:
    wraps = (number - F.pmod(number, F.lit(MODULUS))) / F.lit(MODULUS)
    shift = wraps.cast("long") * WRAP_SHIFT + (seed * SEED_SHIFT + 1)
    return F.pmod(F.pmod(number, F.lit(MODULUS)) + shift, F.lit(MODULUS))


def _draw(name: str, seed: str = "_state") -> Column:
    product = F.pmod(F.col(seed) * F.lit(MULTIPLIERS[name]), F.lit(MODULUS))
    return product.bitwiseXOR(F.shiftright(product, FOLD_BITS))


def _between(name: str, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return F.pmod(_draw(name), F.lit(high - low + 1)) + F.lit(low)


def _one_of(name: str, words: tuple[str, ...]) -> Column:
    index = F.pmod(_draw(name), F.lit(len(words))).cast("int")
    return F.get(F.array(*[F.lit(word) for word in words]), index)


def generate_events(
    ids: DataFrame, id_column: str = "id", events_per_session: int = 1, seed: int = 0
) -> DataFrame:
    """One event per row of ids, every column uniform over its domain.

    The same id and seed always give the same event, on any number of executors.
    """
    row = F.col(id_column).cast("long")
    session = F.floor(row / F.lit(events_per_session)) if events_per_session > 1 else row
    seconds = F.pmod(_draw("event_time"), F.lit(DAYS * 86_400))
    return (
        ids.select(row.alias("_row"), session.alias("_session"))
        .select(
            _seed(F.col("_row"), seed).alias("_seed"),
            F.col("_session"),
            _seed(F.col("_session"), seed).alias("_session_seed"),
        )
        .select(
            "_session",
            _draw("seed", "_seed").alias("_state"),
            _draw("seed", "_session_seed").alias("_session_state"),
        )
        .select(
            F.timestamp_add("SECOND", seconds, F.lit(START).cast("timestamp_ntz")).alias(
                "event_time"
            ),
            _one_of("event_type", TYPES).alias("event_type"),
            _between("product_id", PRODUCT_IDS).alias("product_id"),
            (
                F.lit(FIRST_CATEGORY_ID)
                + _draw("category_high") * CATEGORY_STEP
                + F.pmod(_draw("category_low"), F.lit(CATEGORY_STEP))
            ).alias("category_id"),
            _one_of("category_code", CATEGORIES).alias("category_code"),
            _one_of("brand", BRANDS).alias("brand"),
            (_between("price", PRICE_CENTS) / F.lit(100.0)).alias("price"),
            _between("user_id", USER_IDS).alias("user_id"),
            F.concat_ws("-", "_session", _draw("user_session", "_session_state")).alias(
                "user_session"
            ),
        )
    )


def write_synthetic_csv(
    spark: SparkSession, path: str, size_mb: int, events_per_session: int = 1
) -> None:
    """About size_mb megabytes of synthetic events as CSV files."""
    rows = size_mb * 1024 * 1024 // BYTES_PER_LINE
    write_events_csv(generate_events(spark.range(rows), "id", events_per_session), path)
