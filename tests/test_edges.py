"""Rows and settings the test tables do not hold."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aislewise import operators as op
from aislewise.functions import micros_between, top_category, utc_without_zone
from aislewise.schema import RAW

NOON = dt.datetime(2019, 10, 1, 12, 0, 0)


def event(**changes):
    row = {
        "event_time": NOON,
        "event_type": "view",
        "product_id": 1,
        "category_id": 2_000_000_000_000_000_001,
        "category_code": "electronics.audio",
        "brand": "lg",
        "price": 1.5,
        "user_id": 5,
        "user_session": "s",
    }
    return tuple({**row, **changes}.values())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


@pytest.fixture
def zone(spark):
    def use(name):
        spark.conf.set("spark.sql.session.timeZone", name)

    yield use
    use("UTC")


@pytest.mark.parametrize(
    "change",
    [
        {"price": None},
        {"price": float("nan")},
        {"price": -0.01},
        {"product_id": None},
        {"user_id": None},
        {"event_time": None},
        {"event_type": None},
        {"event_type": "refund"},
        {"user_session": None},
        {"user_session": ""},
        {"user_session": " \t\n"},
        {"user_session": "  \x1f"},
    ],
)
def test_clean_drops(spark, change):
    assert op.clean_events(table(spark, event(**change), event())).count() == 1


def test_clean_keeps(spark):
    rows = [
        event(price=0.0),
        event(brand=None, category_code=None, category_id=None),
        event(user_session=" x "),
        event(event_type="remove_from_cart"),
    ]
    assert op.clean_events(table(spark, *rows)).count() == len(rows)


def test_quality_counts_nan_as_null_and_null_type_as_invalid(spark):
    rows = [event(price=float("nan")), event(price=None), event(event_type=None), event(price=-1.0)]
    report = op.quality_report(table(spark, *rows)).first()
    assert report.total_rows == 4
    assert report.null_price == 2
    assert report.null_event_type == 1
    assert report.invalid_events == 1
    assert report.negative_prices == 1
    longs = {r.column_name: r.null_count for r in op.null_counts(table(spark, *rows)).collect()}
    assert longs == {name: report[f"null_{name}"] for name in RAW.names}


def test_schema_comparison(spark):
    df = table(spark, event())
    assert op.compare_schema(df) == (True, [], [], [])
    other = df.drop("brand", "price").withColumn("note", F.lit("")).withColumn(
        "user_id", F.col("user_id").cast("string")
    )
    found = op.compare_schema(other)
    assert found == (False, ["brand", "price"], ["note"], ["user_id string"])
    with pytest.raises(op.SchemaMismatch):
        found.require()


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        op.require_rows(table(spark))
    op.require_rows(table(spark, event()))
    assert op.verify_input(table(spark)).first().has_rows is False


def test_top_category(spark):
    codes = ["a.b.c", "a", "", ".x", None]
    got = spark.createDataFrame([(c,) for c in codes], "category_code string").select(
        top_category().alias("t")
    )
    assert [r.t for r in got.collect()] == ["a", "a", "", "", "unknown"]


def test_funnel_without_views(spark):
    rows = [event(event_type="cart"), event(event_type="purchase")]
    row = op.conversion_funnel(table(spark, *rows)).first()
    assert (row.view, row.cart, row.purchase, row.remove_from_cart) == (0, 1, 1, 0)
    assert row.cart_rate is None and row.purchase_rate is None


def test_funnel_by_rate_puts_missing_rates_last(spark):
    rows = [
        event(event_type="purchase", category_code="none"),
        event(category_code="low"),
        event(category_code="high"),
        event(event_type="purchase", category_code="high"),
    ]
    best = op.funnel_by_rate(op.conversion_funnel(table(spark, *rows)))
    assert [r.top_category for r in best.collect()] == ["high", "low", "none"]


def test_equal_revenue_goes_by_name(spark):
    rows = [event(event_type="purchase", brand=b, category_code=b) for b in ("c", "a", "b")]
    df = table(spark, *rows)
    assert [r.brand for r in op.top_brands(df, 2).collect()] == ["a", "b"]
    assert [r.top_category for r in op.revenue_by_category(df).collect()] == ["a", "b", "c"]


def test_brand_called_na_is_kept_and_null_is_not(spark):
    rows = [event(event_type="purchase", brand=b) for b in ("NA", None, "NA")]
    [best] = op.top_brands(table(spark, *rows)).collect()
    assert (best.brand, best.num_purchases) == ("NA", 2)


def test_histogram_marks_full_units(spark):
    rows = [event(event_type="purchase")] * 5 + [event()] * 9
    hourly = op.hourly_activity(table(spark, *rows))
    assert [tuple(r) for r in op.hourly_histogram(hourly, unit=2).collect()] == [(12, 5, "##")]
    assert op.hourly_histogram(hourly).first().bar == ""


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone, name):
    zone(name)
    # The first time does not exist in New York, the hour after the second is there twice.
    times = [dt.datetime(2019, 3, 10, 2, 30), dt.datetime(2019, 11, 3, 1, 30)]
    rows = [event(event_time=t + dt.timedelta(microseconds=m)) for m in (0, 7) for t in times]
    df = op.clean_events(table(spark, *rows))
    [session] = op.session_stats(df).select(
        "session_start", "session_end", "session_duration_min"
    ).collect()
    last = times[1] + dt.timedelta(microseconds=7)
    assert session.session_start == times[0] and session.session_end == last
    micros = (last - times[0]) // dt.timedelta(microseconds=1)
    assert session.session_duration_min == micros / 60_000_000
    assert {(r.hour, r["count"]) for r in op.hourly_activity(df).collect()} == {(1, 2), (2, 2)}
    assert df.select(micros_between("event_time", "event_time").alias("m")).first().m == 0


@pytest.mark.parametrize("name", ["UTC", "America/New_York"])
def test_zoned_times_become_utc(spark, zone, name):
    zone(name)
    # Both show as 01:30 on New York clocks.
    seconds = [1_572_759_000, 1_572_762_600]
    zoned = spark.createDataFrame([(s,) for s in seconds], "s long").select(
        F.timestamp_seconds("s").alias("event_time")
    )
    got = [r.event_time for r in utc_without_zone(zoned).collect()]
    assert got == [dt.datetime(2019, 11, 3, 5, 30), dt.datetime(2019, 11, 3, 6, 30)]
