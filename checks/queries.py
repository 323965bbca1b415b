"""One query per operator. Rounding belongs here, not to the operators."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise import functions as fn
from aislewise import operators as op
from aislewise import sources
from aislewise.plans import (
    analyse,
    follow,
    follow_sessions,
    ingest,
    live_events,
    live_rejects,
    rollup_sessions,
    rollup_summary,
    run,
    sync,
    update_rollup,
)
from aislewise.plans.ingest import record_mode
from aislewise.plans.rollup import ledger_of as rollup_ledger
from aislewise.schema import RAW
from aislewise.sinks import pack_types, preview, write_result, write_validated
from aislewise.sources import discover_inputs, load_events, sample_csv, scan_csv, scan_rejects
from aislewise.sources.files import list_files
from aislewise.workspace import scratch_path, stage
from checks.tables import (
    csv_copy,
    csv_in_other_orders,
    csv_parts,
    csv_with_breaks,
    damaged_lines,
    event_table,
    events,
    raw_events,
    raw_events_with_id,
    write_lines,
)

Query = Callable[[SparkSession, str], DataFrame]

# Events per mark of the histogram, to suit the test tables.
HISTOGRAM_UNIT = 20
# Sample size that cuts into the sessions at every scale of the test tables.
SAMPLE_SIZE = 200
# Bytes of a sample block that cuts into one file at every scale.
SAMPLE_BLOCK = 1 << 14
# Splits of a large file with quoted breaks.
LEAST_SPLITS = 1000


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def _as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("long") for name in names})


# Sources


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, csv_copy(raw_events(spark, sf_dir)), pattern="*.csv")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    write_lines(damaged_lines(spark, sf_dir), path)
    return scan_rejects(spark, path).select("line")


def csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    write_lines(damaged_lines(spark, sf_dir), path)
    return scan_csv(spark, path).groupBy("event_type").agg(F.count("*").alias("count"))


def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files of one block each, of which the first two in the order given are taken."""
    whole = stage(raw_events_with_id(spark, sf_dir), "raw")
    parts = [whole.where(F.pmod("event_id", F.lit(4)) == k).select(*RAW.names) for k in range(4)]
    # A shuffle, so that the task that writes a file does nothing else.
    files = [csv_copy(part.repartition(1)) for part in parts]
    return sample_csv(spark, files, pattern="*.csv", block_bytes=1 << 50)


def sample_inside_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks of one larger file, in the order of its lines."""
    path = scratch_path(spark, "damaged")
    # Sorted by many tasks and kept, so that the one that writes the file only reads on.
    lines = damaged_lines(spark, sf_dir, ordered=True).persist(StorageLevel.DISK_ONLY)
    lines.count()
    write_lines(lines.coalesce(1), path)
    lines.unpersist()
    with _splits_of(spark, SAMPLE_BLOCK // 4):
        head = stage(sample_csv(spark, path, block_bytes=SAMPLE_BLOCK), "head")
    return head.groupBy("event_type").agg(
        F.count("*").alias("count"), F.sum("user_id").alias("user_ids"), F.max("user_id").alias("max_user")
    )


def input_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the discovered files of each folder, and whether an absent name was left out."""
    whole = raw_events_with_id(spark, sf_dir)
    counts = []
    for k in range(2):
        folder = csv_copy(whole.where(F.pmod("event_id", F.lit(2)) == k).select(*RAW.names))
        names = sorted(path.rsplit("/", 1)[-1] for path in spark.read.text(folder).inputFiles())
        found = discover_inputs(spark, folder, ["absent.csv", *names])
        counts.append(
            scan_csv(spark, found).agg(
                F.lit(k).alias("folder"),
                F.lit([f.rsplit("/", 1)[-1] for f in found] == names).alias("as_listed"),
                F.count("*").alias("row_count"),
            )
        )
    return counts[0].unionByName(counts[1])


def validated_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "validated")
    write_validated(events(spark, sf_dir), path)
    return load_events(spark, path).select(*RAW.names)


def generate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.generate_events(event_table(spark, sf_dir), "event_id", events_per_session=5)


@contextlib.contextmanager
def _splits_of(spark: SparkSession, size: int) -> Iterator[None]:
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def csv_headers_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three headers as one table; the last one has no brand."""
    return scan_csv(spark, csv_in_other_orders(spark, sf_dir), pattern="*.csv").select(
        *RAW.names, "loaded_by"
    )


def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with line breaks, read in splits of 16 KB, many of which begin inside a record.

    Opening a split costs the same whatever its size, so a large table has about LEAST_SPLITS larger ones.
    """
    path = csv_with_breaks(spark, sf_dir)
    length = list_files(spark, path, "*.csv").agg(F.sum("length")).first()[0] or 0
    with _splits_of(spark, max(1 << 14, length // LEAST_SPLITS)):
        return stage(scan_csv(spark, path, pattern="*.csv", multiline=True), "records")


# Validation and cleaning


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = raw_events(spark, sf_dir).drop("brand").withColumn("loaded_by", F.lit("batch"))
    return op.schema_report(scan_csv(spark, csv_copy(altered)))


def input_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "validated")
    write_validated(events(spark, sf_dir), path)
    return op.verify_input(load_events(spark, path))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.quality_report(raw_events(spark, sf_dir))


def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_counts(raw_events(spark, sf_dir))


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir)


# Sinks


def validated_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "validated")
    write_validated(events(spark, sf_dir), path, compact=True)
    return load_events(spark, path).groupBy("event_type").agg(F.count("*").alias("count"))


def packed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of many small files, packed: files by type within the bound, rows as before."""
    path = scratch_path(spark, "validated")
    write_validated(events(spark, sf_dir).repartition(12), path)
    whole = list_files(spark, path, "*.parquet").agg(F.sum("length")).first()[0]
    size = whole // 6
    pack_types(spark, path, size)
    file = F.regexp_extract("path", "/event_type=([^/]*)/", 1)
    found = list_files(spark, path, "*.parquet").groupBy(file.alias("event_type"))
    found = found.agg((F.count("*") <= 2 * F.ceil(F.sum("length") / size)).alias("within_bound"))
    stored = load_events(spark, path).groupBy("event_type")
    sums = stored.agg(F.count("*").alias("count"), F.round(F.sum("price"), 2).alias("price_sum"))
    return sums.join(found, "event_type")


def follow_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The following job over a folder that loses a file and gains one: revenue and sessions."""
    parts = csv_parts(spark, sf_dir, 3)
    output = scratch_path(spark, "job")
    follow(spark, parts[:2], output, "*.csv")
    paths = follow(spark, parts[1:], output, "*.csv")
    revenue = spark.read.parquet(paths["revenue_by_category"]).select(
        F.lit("revenue").alias("table_name"),
        F.col("top_category").alias("key"),
        F.round("total_revenue", 2).alias("value"),
    )
    sessions = spark.read.parquet(paths["session_stats"]).agg(
        F.lit("sessions").alias("table_name"),
        F.lit("all").alias("key"),
        F.count("*").cast("double").alias("value"),
    )
    return revenue.unionByName(sessions)


def result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "result")
    write_result(op.revenue_by_category(events(spark, sf_dir)), path)
    return _rounded(spark.read.parquet(path), total_revenue=2, avg_price=4)


def result_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "result")
    write_result(op.revenue_by_category(events(spark, sf_dir)), path)
    stored = preview(spark, path, F.desc("total_revenue"), F.col("top_category"), rows=5)
    return _rounded(stored, total_revenue=2, avg_price=4)


def ingest_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: a first one, one to be skipped, and one after a change of mode."""
    inputs = csv_copy(raw_events(spark, sf_dir))
    target = scratch_path(spark, "validated")
    first = ingest(spark, inputs, target)
    again = ingest(spark, inputs, target)
    record_mode(spark, target, sample=True)
    changed = ingest(spark, inputs, target)
    return spark.createDataFrame(
        [("first", *first), ("again", *again), ("changed", *changed)],
        "run string, skipped boolean, lines_read long, lines_rejected long, rows_written long",
    )


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files; then one goes and one comes; then nothing changes. What each run read and what is stored."""
    parts = csv_parts(spark, sf_dir, 4)
    target = scratch_path(spark, "synced")
    steps = []
    for step, inputs in (("first", parts[:3]), ("changed", parts[1:]), ("again", parts[1:])):
        done = sync(spark, inputs, target, "*.csv")
        n = len([f for f in spark.read.text(inputs, pathGlobFilter="*.csv").inputFiles()])
        stored = live_events(spark, target).agg(F.count("*").alias("n"), F.sum("price").alias("s")).first()
        steps.append(
            (step, done.files_added + done.files_kept == n, done.files_removed > 0, done.lines_read,
             done.rows_written, done.lines_rejected, stored.n, round(stored.s, 2))
        )
    return spark.createDataFrame(
        steps,
        "step string, files_as_listed boolean, files_gone boolean, lines_read long, rows_written long, "
        "lines_rejected long, rows_stored long, price_sum double",
    )


def ingest_synced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events after a file has gone and one has come: those of a full ingest."""
    parts = csv_parts(spark, sf_dir, 4)
    target = scratch_path(spark, "synced")
    sync(spark, parts[:3], target, "*.csv")
    sync(spark, parts[1:], target, "*.csv")
    return live_events(spark, target)


def ingest_synced_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines of all files, one of which came later."""
    paths = [scratch_path(spark, "damaged") for _ in range(3)]
    whole = damaged_lines(spark, sf_dir)
    shares = [F.pmod(F.xxhash64("line"), F.lit(3)) == k for k in range(3)]
    for path, share in zip(paths, shares):
        write_lines(whole.where(share), path)
    target = scratch_path(spark, "synced")
    sync(spark, paths[:2], target)
    sync(spark, paths[::-1], target)
    return live_rejects(spark, target).select("line")


def job_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report that the whole job counts while it ingests."""
    paths = run(spark, csv_copy(raw_events(spark, sf_dir)), scratch_path(spark, "job"))
    return spark.read.parquet(paths["quality_report"])


# Analyses


def top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_events(spark, sf_dir)
        .groupBy("category_code", fn.top_category().alias("top_category"))
        .agg(F.count("*").alias("count"))
    )


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = op.revenue_by_category(events(spark, sf_dir))
    return _rounded(revenue, total_revenue=2, avg_price=4)


def product_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.product_rank(events(spark, sf_dir))


def product_rank_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.product_rank(events(spark, sf_dir), top_n=5)


def product_rank_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = stage(op.product_sales(events(spark, sf_dir)), "sales")
    return op.rank_products(sales, measure="num_purchases")


def conversion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    funnel = op.conversion_funnel(events(spark, sf_dir))
    return _rounded(funnel, cart_rate=6, purchase_rate=6)


def hourly_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_long(op.hourly_activity(events(spark, sf_dir)), "hour")


def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.session_stats(events(spark, sf_dir)), total_spend=2)


def session_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.session_partials(events(spark, sf_dir)), total_spend=2)


def session_stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = stage(op.session_partials(events(spark, sf_dir)), "partials")
    return _rounded(op.merge_session_partials(partials), total_spend=2)


def _rollup_of_two(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A rollup of most events, then of the rest, which few sessions have; what the second update did."""
    found = stage(events(spark, sf_dir), "events")
    late = (F.pmod("user_id", F.lit(50)) == 0) & (F.pmod("product_id", F.lit(2)) == 0)
    update_rollup(spark, folder, op.session_stats(found.where(~late)), buckets=64)
    before = rollup_ledger(spark, folder).latest().where("bucket is not null")
    before = stage(before.select("bucket", "version"), "before")
    done = update_rollup(spark, folder, op.session_stats(found.where(late)))
    after = rollup_ledger(spark, folder).latest().where("bucket is not null")
    after = after.select("bucket", F.col("version").alias("now"))
    same = F.count_if(F.col("version") == F.col("now"))
    return before.join(after, "bucket", "full").agg(
        (same == F.lit(done.untouched)).alias("others_keep_files"),
        (F.lit(done.untouched) > 0).alias("has_untouched"),
        (F.lit(done.rewritten) > 0).alias("has_rewritten"),
        (F.count("*") == done.untouched + done.rewritten).alias("all_buckets"),
    )


def session_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session statistics of two batches, merged into a standing rollup."""
    folder = scratch_path(spark, "rollup")
    _rollup_of_two(spark, sf_dir, folder)
    return _rounded(rollup_sessions(spark, folder), total_spend=2)


def session_rollup_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of synced files, of which one goes and one comes."""
    parts = csv_parts(spark, sf_dir, 4)
    target, folder = (scratch_path(spark, name) for name in ("synced", "rollup"))
    for inputs in (parts[:2], parts[1:], parts[1:]):
        sync(spark, inputs, target, "*.csv")
        follow_sessions(spark, target, folder, buckets=16)
    return _rounded(rollup_sessions(spark, folder), total_spend=2)


def session_rollup_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That the second update leaves the buckets alone which its sessions don't fall into."""
    return _rollup_of_two(spark, sf_dir, scratch_path(spark, "rollup"))


def session_rollup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary from the buckets' sketches; the merged median is checked by its rank."""
    folder = scratch_path(spark, "rollup")
    _rollup_of_two(spark, sf_dir, folder)
    summary = rollup_summary(spark, folder).first()
    duration = F.col("session_duration_min")
    rows = F.count("*")
    return rollup_sessions(spark, folder).agg(
        (rows == summary.num_sessions).alias("counts_sessions"),
        F.lit(round(summary.avg_events, 6)).alias("avg_events"),
        F.lit(round(summary.avg_spend, 4)).alias("avg_spend"),
        (
            (F.count_if(duration < summary.median_duration_min) <= rows * 0.502)
            & (F.count_if(duration <= summary.median_duration_min) >= rows * 0.498)
        ).alias("median_within_bound"),
    )


def top_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.top_brands(events(spark, sf_dir)), total_revenue=2)


# Report views


def revenue_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = op.revenue_by_category(events(spark, sf_dir))
    best = op.top_rows(revenue, F.desc("total_revenue"), "top_category")
    return _rounded(best, total_revenue=2, avg_price=4)


def brands_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = op.top_brands(events(spark, sf_dir))
    return _rounded(op.top_rows(brands, F.desc("total_revenue"), "brand"), total_revenue=2)


def funnel_top_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = op.funnel_by_rate(op.conversion_funnel(events(spark, sf_dir)))
    return _rounded(best, cart_rate=6, purchase_rate=6)


def funnel_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.funnel_steps(op.conversion_funnel(events(spark, sf_dir)))


def hourly_purchase_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = op.hourly_activity(events(spark, sf_dir))
    return _as_long(op.hourly_histogram(hourly, unit=HISTOGRAM_UNIT), "hour")


def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = stage(op.session_stats(events(spark, sf_dir)), "sessions")
    return _rounded(
        op.session_summary(sessions), avg_events=6, median_duration_min=6, avg_spend=4
    )


def session_summary_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketched median is checked by its rank, which may be off by 1 in 10,000."""
    sessions = stage(op.session_stats(events(spark, sf_dir)), "sessions")
    summary = stage(op.session_summary(sessions, approx=True), "summary")
    median = summary.select("median_duration_min").scalar()
    below = F.count_if(F.col("session_duration_min") < median)
    upto = F.count_if(F.col("session_duration_min") <= median)
    rows = F.count("*")
    means = summary.select("avg_events", "avg_spend").first()
    return sessions.agg(
        rows.alias("num_sessions"),
        F.lit(round(means.avg_events, 6)).alias("avg_events"),
        F.lit(round(means.avg_spend, 4)).alias("avg_spend"),
        ((below <= rows * 0.5001) & (upto >= rows * 0.4999)).alias("median_within_bound"),
    )


def session_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = stage(op.session_stats(events(spark, sf_dir)), "sessions")
    return _rounded(op.session_sample(sessions, SAMPLE_SIZE), total_spend=2)


def end_to_end_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in, all results out; one row per stored table."""
    inputs = csv_copy(raw_events(spark, sf_dir))
    output = scratch_path(spark, "job")
    ingest(spark, inputs, f"{output}/validated")
    paths = {"validated": f"{output}/validated"}
    paths |= analyse(spark, paths["validated"], f"{output}/results")
    counts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count")
        )
        for name, path in paths.items()
    ]
    united = counts[0]
    for one in counts[1:]:
        united = united.unionByName(one)
    return united


def end_to_end_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job's values: revenue, funnel and brands by name, and sums over all sessions."""
    paths = run(spark, csv_copy(raw_events(spark, sf_dir)), scratch_path(spark, "job"))

    def values(name: str, key: str, *measures: str) -> list[DataFrame]:
        stored = spark.read.parquet(paths[name])
        return [
            stored.select(
                F.lit(name).alias("table_name"),
                F.col(key).alias("key"),
                F.lit(m).alias("measure"),
                F.round(F.col(m).cast("double"), 2).alias("value"),
            )
            for m in measures
        ]

    sessions = spark.read.parquet(paths["session_stats"]).agg(
        F.lit("session_stats").alias("table_name"),
        F.lit("all").alias("key"),
        F.lit("num_events").alias("measure"),
        F.sum("num_events").cast("double").alias("value"),
    )
    found = [
        *values("revenue_by_category", "top_category", "total_revenue", "num_purchases"),
        *values("conversion_funnel", "top_category", "view", "cart", "purchase"),
        *values("top_brands", "brand", "total_revenue"),
        sessions,
    ]
    return functools.reduce(DataFrame.unionByName, found)


def job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines that the whole job stores."""
    path = scratch_path(spark, "damaged")
    write_lines(damaged_lines(spark, sf_dir), path)
    paths = run(spark, path, scratch_path(spark, "job"), rejects=True)
    return spark.read.parquet(paths["rejects"]).select("line")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_scan,
        csv_rejects,
        csv_accepted,
        sample_head,
        sample_inside_file,
        csv_headers_by_file,
        csv_quoted_breaks,
        input_discovery,
        validated_scan,
        generate_events,
        schema_report,
        input_verify,
        dq_report,
        dq_null_counts,
        clean_events,
        validated_write,
        packed_layout,
        result_roundtrip,
        result_preview,
        ingest_idempotent,
        ingest_incremental,
        ingest_synced_events,
        ingest_synced_rejects,
        job_quality,
        top_category,
        revenue_by_category,
        product_rank,
        product_rank_top5,
        product_rank_by_count,
        conversion_funnel,
        hourly_activity,
        session_stats,
        session_partials,
        session_stats_merged,
        session_rollup,
        session_rollup_follows,
        session_rollup_buckets,
        session_rollup_summary,
        top_brands,
        revenue_top10,
        brands_top10,
        funnel_top_rate,
        funnel_long,
        hourly_purchase_histogram,
        session_summary,
        session_summary_approx,
        session_sample,
        end_to_end_row_counts,
        end_to_end_values,
        job_rejects,
        follow_values,
    )
}
