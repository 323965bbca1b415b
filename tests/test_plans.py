"""Physical plans, the ingest marker and the whole job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aislewise import operators as op
from aislewise import session
from aislewise.plans import ingest, run
from aislewise.plans.ingest import MARKER, record_mode
from aislewise.schema import RAW
from aislewise.session import size_shuffles
from aislewise.sinks import preview, write_events_csv, write_validated
from aislewise.sources import generate_events, load_events
from aislewise.workspace import scratch_path
from checks.queries import QUERIES
from checks.tables import csv_copy, events, raw_events
from tests.test_oracle import SF_DIR


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "validated")
    write_validated(events(spark, SF_DIR), path)
    return load_events(spark, path)


def test_purchases_read_one_partition_and_their_columns(stored):
    plan = plan_of(op.revenue_by_category(stored))
    assert "(event_type" in plan and "= purchase)" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<category_code:string,price:double>" in plan
    assert plan.count("hashpartitioning") == 1


def test_top_brands_takes_without_a_full_sort(stored):
    plan = plan_of(op.top_brands(stored))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_funnel_aggregates_once(stored):
    plan = plan_of(op.conversion_funnel(stored))
    assert plan.count("hashpartitioning") == 1
    assert "ReadSchema: struct<category_code:string>" in plan


def test_sessions_combine_before_their_only_shuffle(stored):
    plan = plan_of(op.session_stats(stored))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_pushed_filters(stored):
    plan = plan_of(stored.filter(F.col("price") >= 5).select("brand"))
    assert "GreaterThanOrEqual(price,5.0)" in plan


def test_cleaning_reaches_the_scan(spark, stored):
    pushed = plan_of(op.clean_events(stored)).split("PushedFilters: ")[1]
    # The plan text is cut off after a few filters.
    for name in ("user_id", "product_id", "price", "event_time"):
        assert f"IsNotNull({name})" in pushed


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_totals_agree(stored):
    rows = stored.count()
    funnel = op.conversion_funnel(stored)
    four = F.col("view") + F.col("cart") + F.col("purchase") + F.col("remove_from_cart")
    assert funnel.agg(F.sum(four)).first()[0] == rows
    assert op.hourly_activity(stored).agg(F.sum("count")).first()[0] == rows
    assert op.session_stats(stored).agg(F.sum("num_events")).first()[0] == rows
    revenue = op.revenue_by_category(stored).agg(F.sum("total_revenue")).first()[0]
    bought = stored.filter("event_type = 'purchase'").agg(F.sum("price")).first()[0]
    assert revenue == pytest.approx(bought)


def test_write_appends_or_overwrites(spark):
    path = scratch_path(spark, "validated")
    df = events(spark, SF_DIR)
    rows = df.count()
    write_validated(df, path)
    write_validated(df, path, overwrite=False)
    assert load_events(spark, path).count() == 2 * rows
    write_validated(df, path, compact=True)
    assert load_events(spark, path).count() == rows


def test_compact_write_cuts_a_large_event_type(spark):
    path = scratch_path(spark, "validated")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "16k")
    try:
        many = generate_events(spark.range(50_000, numPartitions=16))
        write_validated(many, path, compact=True)
    finally:
        spark.conf.unset(key)
    files = load_events(spark, path).inputFiles()
    assert sum("event_type=view" in name for name in files) > 1
    assert load_events(spark, path).count() == many.count()


@pytest.mark.parametrize("top_n", [5, 1000, 1001, 5000])
def test_ranks_have_one_plan_without_a_window_over_products(stored, top_n):
    plan = plan_of(op.product_rank(stored, top_n=top_n))
    assert "WindowGroupLimit" not in plan
    assert plan.count("Window [") == plan_of(op.product_rank(stored, top_n=5)).count("Window [")
    assert "row_number" not in plan and "_block" in plan


def test_overwrite_leaves_no_old_partitions(spark, stored):
    path = scratch_path(spark, "overwritten")
    write_validated(stored, path)
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        write_validated(stored.where("event_type = 'view'"), path)
    finally:
        spark.conf.unset(key)
    assert [r.event_type for r in load_events(spark, path).select("event_type").distinct().collect()] == ["view"]


def test_shuffles_fit_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    size_shuffles(spark, [SF_DIR])
    assert spark.conf.get(key) == before


def test_sizes_follow_the_input_unless_given(spark, monkeypatch):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(k) for k in keys]
    path = csv_copy(raw_events(spark, SF_DIR))
    monkeypatch.setattr(session, "_given", lambda spark, key: False)
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 100)
    monkeypatch.setattr(session, "BLOCK_BYTES", 10)
    monkeypatch.setattr(session, "MOST_SPLITS", 100)
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    try:
        size_shuffles(spark, path)
        assert int(spark.conf.get(keys[0])) == total // 100
        assert int(spark.conf.get(keys[1])) == 10 * -(-total // 1000)
        size_shuffles(spark, [path], most=30_000)
        assert int(spark.conf.get(keys[0])) == 300 and int(spark.conf.get(keys[1])) == 300
        size_shuffles(spark, path, pattern="*.none")
        assert int(spark.conf.get(keys[0])) == 200 and int(spark.conf.get(keys[1])) == 10
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


def test_sample_orders_no_more_than_a_bucket_in_a_task(spark, stored):
    plan = plan_of(op.session_sample(op.session_stats(stored), 1_000_000))
    assert "TakeOrderedAndProject" not in plan and "Limit" not in plan


def test_job_tells_what_it_read(spark):
    inputs, output = csv_copy(raw_events(spark, SF_DIR)), scratch_path(spark, "job")
    paths = run(spark, inputs, output, rejects=True)
    first = spark.read.parquet(paths["ingest_outcome"]).first()
    assert not first.skipped and first.lines_read == raw_events(spark, SF_DIR).count()
    assert first.lines_rejected == 0 and spark.read.parquet(paths["rejects"]).isEmpty()
    again = run(spark, inputs, output, rejects=True)
    assert spark.read.parquet(again["ingest_outcome"]).first().skipped


def test_foreign_int96_times(spark):
    path = scratch_path(spark, "foreign")
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        df = events(spark, SF_DIR)
        zoned = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
        zoned.write.partitionBy("event_type").parquet(path)
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        back = load_events(spark, path).select(*RAW.names)
        assert back.schema["event_time"].dataType.simpleString() == "timestamp_ntz"
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ingest_marker(spark):
    inputs = csv_copy(raw_events(spark, SF_DIR))
    target = scratch_path(spark, "validated")
    assert not ingest(spark, inputs, target).skipped
    assert ingest(spark, inputs, target).skipped
    # The marker is no data file.
    assert "sample" not in load_events(spark, target).columns
    # Unreadable marker.
    spark.range(1).selectExpr("'not json' AS value").write.mode("overwrite").text(
        f"{target}/{MARKER}"
    )
    assert not ingest(spark, inputs, target).skipped
    # Marker of the other mode.
    assert not ingest(spark, inputs, target, sample=True).skipped
    assert ingest(spark, inputs, target, sample=True).skipped
    # Marker without events.
    empty = scratch_path(spark, "validated")
    record_mode(spark, empty, sample=False)
    assert not ingest(spark, inputs, empty).skipped


def test_ingest_refuses_missing_columns(spark):
    path = scratch_path(spark, "csv")
    write_events_csv(raw_events(spark, SF_DIR).drop("price"), path)
    target = scratch_path(spark, "validated")
    with pytest.raises(op.SchemaMismatch, match="price"):
        ingest(spark, path, target)


def test_whole_job(spark):
    output = scratch_path(spark, "job")
    paths = run(spark, csv_copy(raw_events(spark, SF_DIR)), output)
    first = preview(spark, paths["top_brands"], F.desc("total_revenue"), rows=3).collect()
    expected = op.top_brands(events(spark, SF_DIR), 3).collect()
    assert [r.brand for r in first] == [r.brand for r in expected]
    # A small result is a single file.
    for name in ("revenue_by_category", "top_brands", "session_summary"):
        assert len(spark.read.parquet(paths[name]).inputFiles()) == 1
    assert spark.read.parquet(paths["session_stats"]).drop("total_spend").exceptAll(
        op.session_stats(events(spark, SF_DIR)).drop("total_spend")
    ).isEmpty()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    settings = {"spark.checkpoint.dir": None, "spark.master": "spark://somewhere:7077"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: settings.get(key))
    with pytest.raises(RuntimeError):
        scratch_path(spark, "x")
    settings["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert scratch_path(spark, "x").startswith("hdfs:///shared/x-")
    settings.update({"spark.checkpoint.dir": None, "spark.master": "local[2]"})
    assert "/aislewise-" in scratch_path(spark, "x")
