"""Shape of the event table."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, event types and input file names that the data
# sets of this domain use.
RAW = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)
EVENT_TYPES = ("view", "cart", "purchase", "remove_from_cart")
KEY_COLUMNS = ("user_id", "product_id", "price", "event_time", "user_session")
MONTHLY_FILES = ("2019-Oct.csv", "2019-Nov.csv")

# Size of one input block; sample mode keeps the first two.
BLOCK_BYTES = 64 * 1024 * 1024
SAMPLE_BLOCKS = 2

CORRUPT = "_corrupt_record"
