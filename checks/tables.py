"""The test tables seen as raw events, with every fault that cleaning must catch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.operators import clean_events
from aislewise.schema import RAW
from aislewise.sinks import csv_sink, write_events_csv
from aislewise.workspace import scratch_path


# Declared, so that opening a table does not cost a job that reads its footer.
EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)
PART = "p_partkey long, p_name string, p_brand string, p_type string"


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _every(n: int) -> Column:
    return F.pmod("event_id", F.lit(n)) == 0


def raw_events_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES.md section 2, plus event_id.

    The join key has few values, each with many events. The part side is left to
    the size check of the optimizer: small enough it is broadcast, otherwise the
    adaptive skew join splits the large keys.
    """
    # Without nulls the join needs no filter, which would parse the text once more.
    key = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(-1))
    events = event_table(spark, sf_dir).withColumn("k", key)
    parts = spark.read.schema(PART).parquet(f"{sf_dir}/part.parquet")
    parts = parts.withColumnRenamed("p_partkey", "k")
    return events.join(parts, "k").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", "cart")
        .when(F.col("event_type") == "signup", "remove_from_cart")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(~_every(103), F.col("k")).alias("product_id"),
        (F.lit(2_000_000_000_000_000_000) + F.col("k")).alias("category_id"),
        F.when(
            F.pmod("k", F.lit(10)) != 0, F.concat_ws(".", F.lower("p_type"), "p_name")
        ).alias("category_code"),
        F.when(F.pmod("k", F.lit(7)) != 0, F.col("p_brand")).alias("brand"),
        F.when(_every(89), None)
        .when(_every(97), -F.col("value"))
        .otherwise(F.col("value"))
        .alias("price"),
        "user_id",
        F.when(_every(101), "  ")
        .when(_every(107), None)
        .otherwise(F.concat_ws("-", "user_id", F.date_format("ts", "yyyyMMdd")))
        .alias("user_session"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_with_id(spark, sf_dir).select(*RAW.names)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(raw_events(spark, sf_dir))


def csv_copy(df: DataFrame) -> str:
    """df as CSV files in the shared scratch folder."""
    path = scratch_path(df.sparkSession, "csv")
    write_events_csv(df, path, csv_sink.MICROS)
    return path


def damaged_lines(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """CSV lines of all events, some with a field too many, too few or of the wrong type."""
    fields = [
        F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")),
        F.col("event_type"),
        F.when(_every(17), "x").otherwise(F.col("product_id").cast("string")),
        F.col("category_id").cast("string"),
        F.col("category_code"),
        F.col("brand"),
    ]
    rest = [
        F.when(F.col("price").isNotNull(), F.format_string("%.2f", "price")),
        F.col("user_id").cast("string"),
        F.col("user_session"),
    ]

    def line(columns: list[Column]) -> Column:
        return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])

    whole = raw_events_with_id(spark, sf_dir)
    return (whole.orderBy("event_id") if ordered else whole).select(
        F.when(_every(11), line([*fields, *rest, F.lit("more")]))
        .when(_every(13), line(fields))
        .otherwise(line([*fields, *rest]))
        .alias("line")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as they are, each file headed by the column names."""
    # With a separator that no line holds, the writer has nothing to quote.
    (
        lines.toDF(",".join(RAW.names))
        .write.option("header", True)
        .option("sep", "\x01")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def csv_parts(spark: SparkSession, sf_dir: str, n: int) -> list[str]:
    """The raw events as n CSV folders by event_id modulo n."""
    whole = raw_events_with_id(spark, sf_dir)
    return [csv_copy(whole.where(F.pmod("event_id", F.lit(n)) == k).select(*RAW.names)) for k in range(n)]


def csv_in_other_orders(spark: SparkSession, sf_dir: str) -> str:
    """One folder of CSV files with three orders of columns; the last also has a column more and one less."""
    whole = raw_events_with_id(spark, sf_dir)
    orders = [
        RAW.names,
        [*reversed(RAW.names)],
        ["loaded_by", *[c for c in sorted(RAW.names) if c != "brand"]],
    ]
    path = scratch_path(spark, "csv")
    for k, order in enumerate(orders):
        part = whole.where(F.pmod("event_id", F.lit(3)) == k).withColumn("loaded_by", F.lit("batch"))
        write_events_csv(part.select(*order), path, csv_sink.MICROS, mode="append")
    return path


def broken_brand() -> Column:
    """A brand with line breaks and quotes in it for every third event."""
    return F.when(_every(3), F.concat(F.coalesce("brand", F.lit("no")), F.lit('\n"or"\n\nnone'))).otherwise(
        F.col("brand")
    )


def csv_with_breaks(spark: SparkSession, sf_dir: str) -> str:
    """CSV files whose brands have line breaks."""
    whole = raw_events_with_id(spark, sf_dir).withColumn("brand", broken_brand())
    return csv_copy(whole.select(*RAW.names))
