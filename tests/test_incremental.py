"""Sync with a changing folder, the standing rollup, one-pass rejects and quality, and sizing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aislewise.operators import clean_events, quality_report, session_stats, session_summary
from aislewise.plans import (
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
from aislewise.plans.incremental import ledger_of
from aislewise.plans.ingest import events_folder, ingest_report, quality_row
from aislewise.plans.rollup import bucket_of
from aislewise.plans.rollup import ledger_of as rollup_ledger
from aislewise.schema import RAW
from aislewise.session import MOST_BLOCKS, plan_aggregation
from aislewise.sinks import pack_types, write_validated
from aislewise.sinks.parquet_sink import grade_lines
from aislewise.sources import generate_events, load_events, load_rejects, scan_csv
from aislewise.sources.csv_events import parse_csv
from aislewise.workspace import scratch_path, stage
from tests.test_csv import GOOD, HEADER, LINES, write


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def lines_of(user, n):
    return [GOOD.replace(",5,abc", f",{user},s{user}-{k}") for k in range(n)]


def test_sync_follows_the_folder(spark, tmp_path):
    target = scratch_path(spark, "synced")
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", HEADER, *lines_of(1, 3), *LINES)
    write(folder / "b.csv", HEADER, *lines_of(2, 4))
    first = sync(spark, str(folder), target)
    assert first == (2, 0, 0, 14, 9, 3)
    assert sync(spark, str(folder), target) == (0, 0, 2, 0, 0, 0)

    (folder / "b.csv").unlink()
    write(folder / "c.csv", HEADER.replace("brand,price", "price,brand"), *[
        line.replace("lg,1.50", "1.50,lg") for line in lines_of(3, 5)
    ])
    write(folder / "empty.csv", "")
    changed = sync(spark, str(folder), target)
    assert (changed.files_added, changed.files_removed, changed.files_kept) == (2, 1, 1)
    assert changed.lines_read == 5 and changed.rows_written == 5
    assert same(live_events(spark, target), clean_events(scan_csv(spark, str(folder)).select(*RAW.names)))
    assert sorted(r.line for r in live_rejects(spark, target).collect()) == sorted(LINES[2:5])

    write(folder / "a.csv", HEADER, *lines_of(9, 1))
    replaced = sync(spark, str(folder), target)
    assert (replaced.files_added, replaced.files_removed, replaced.files_kept) == (1, 1, 2)
    assert live_rejects(spark, target).isEmpty()
    assert {r.user_id for r in live_events(spark, target).collect()} == {3, 9}

    assert sync(spark, str(folder), target, pattern="none*") == (0, 3, 0, 0, 0, 0)
    assert live_events(spark, target).isEmpty() and live_events(spark, target).schema == RAW


def test_an_interrupted_sync_is_not_seen(spark, tmp_path, monkeypatch):
    target = scratch_path(spark, "synced")
    path = write(tmp_path / "a.csv", HEADER, *lines_of(1, 3))
    sync(spark, path, target)
    more = write(tmp_path / "b.csv", HEADER, *lines_of(2, 4))

    def fails(self, rows):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("aislewise.plans.ledger.Ledger.publish", fails)
        with pytest.raises(OSError):
            sync(spark, [path, more], target)
    assert live_events(spark, target).count() == 3
    assert ledger_of(spark, target).latest().count() == 1
    assert sync(spark, [path, more], target).rows_written == 4
    assert live_events(spark, target).count() == 7
    with pytest.raises(ValueError, match="listed twice"):
        sync(spark, [path, path, str(tmp_path)], target)


def test_one_parse_gives_events_and_rejects(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *LINES)
    plan = grade_lines(parse_csv(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    target = scratch_path(spark, "target")
    done = ingest(spark, path, target, rejects=True)
    assert done == (False, 7, 3, 2)
    events = load_events(spark, events_folder(target, True))
    assert events.count() == 2 and set(RAW.names) <= set(events.columns)
    assert sorted(r.line for r in load_rejects(spark, target).collect()) == sorted(LINES[2:5])
    assert ingest(spark, path, target, rejects=True).skipped
    # Another mode replaces all of it.
    assert not ingest(spark, path, target).skipped
    assert load_events(spark, target).columns[-1] == "event_type"
    assert load_events(spark, target).count() == 2
    assert load_rejects(spark, target).isEmpty()


def test_quality_is_counted_by_the_ingest(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *LINES)
    target = scratch_path(spark, "target")
    ingest(spark, path, target)
    counted, expected = quality_row(spark, target), quality_report(scan_csv(spark, path))
    assert counted.first().asDict() == expected.first().asDict()
    assert ingest_report(spark, target)["sessions"] == 1
    paths = run(spark, path, scratch_path(spark, "job"), rejects=True)
    assert spark.read.parquet(paths["quality_report"]).first().asDict() == expected.first().asDict()
    assert spark.read.parquet(paths["rejects"]).count() == 3


def test_a_file_replaced_by_one_of_equal_length_is_ingested_again(spark, tmp_path):
    import os

    path = write(tmp_path / "a.csv", HEADER, *lines_of(1, 1))
    other = write(tmp_path / "b.csv", HEADER, *lines_of(1, 1))
    for p, t in ((path, 1_600_000_000), (other, 1_600_000_900)):
        os.utime(p, (t, t))
    target = scratch_path(spark, "target")
    assert not ingest(spark, str(tmp_path), target).skipped
    write(tmp_path / "a.csv", HEADER, *lines_of(2, 1))
    os.utime(path, (1_600_000_100, 1_600_000_100))
    # The number of files, their bytes and the newest time are as before.
    assert not ingest(spark, str(tmp_path), target).skipped


def test_rollup_equals_the_statistics_of_all_batches(spark):
    events = generate_events(spark.range(3000), events_per_session=5)
    folder = scratch_path(spark, "rollup")
    assert rollup_sessions(spark, folder).isEmpty()
    assert rollup_summary(spark, folder).first().asDict() == {
        "num_sessions": 0, "avg_events": None, "median_duration_min": None, "avg_spend": None
    }
    for k in range(3):
        batch = events.where(F.pmod(F.xxhash64("product_id"), F.lit(3)) == k)
        update_rollup(spark, folder, session_stats(batch), buckets=16)
    whole = session_stats(events)
    rounded = [df.withColumn("total_spend", F.round("total_spend", 2)) for df in (whole, rollup_sessions(spark, folder))]
    assert same(*[df.select(*sorted(df.columns)) for df in rounded])
    exact, merged = session_summary(whole).first(), rollup_summary(spark, folder).first()
    assert merged.num_sessions == exact.num_sessions
    assert merged.avg_events == pytest.approx(exact.avg_events)
    assert merged.avg_spend == pytest.approx(exact.avg_spend)
    assert merged.median_duration_min == pytest.approx(exact.median_duration_min, rel=0.02)


def test_buckets_without_sessions_of_an_update_keep_their_files(spark):
    events = generate_events(spark.range(2000), events_per_session=5)
    folder = scratch_path(spark, "rollup")
    update_rollup(spark, folder, session_stats(events), buckets=8)

    def files():
        rows = rollup_ledger(spark, folder).latest().where("bucket is not null").collect()
        return {r.bucket: r.version for r in rows}

    before = files()
    one = events.limit(1)
    done = update_rollup(spark, folder, session_stats(one), buckets=999)
    after = files()
    assert done == (1, 7)
    assert sorted(before[b] == after[b] for b in before) == [False] + [True] * 7
    # A bucket taken anew: its sessions are those of the events given.
    bucket = session_stats(one).select(bucket_of(8).alias("bucket"))
    whole = session_stats(events).withColumn("bucket", bucket_of(8)).join(bucket, "bucket").drop("bucket")
    update_rollup(spark, folder, whole, replace=bucket)
    found = rollup_sessions(spark, folder)
    assert found.agg(F.sum("num_events")).first()[0] == 2000
    update_rollup(spark, folder, whole.limit(0), replace=bucket)
    assert rollup_sessions(spark, folder).join(whole, "user_session", "left_semi").isEmpty()


def test_the_rollup_follows_the_files(spark, tmp_path):
    target, folder = scratch_path(spark, "synced"), scratch_path(spark, "rollup")
    paths = {}
    for k, users in enumerate([(1, 2), (2, 3), (3, 4), (9,)]):
        lines = [line for u in users for line in lines_of(u, 30)]
        paths[k] = write(tmp_path / f"{k}.csv", HEADER, *lines)
    paths[4] = write(tmp_path / "4.csv", HEADER, *LINES[2:5])
    for present in ([0, 1], [0, 1], [1, 2, 4], [2, 3], [3, 4], [0, 1, 2, 3]):
        sync(spark, [paths[k] for k in present], target)
        done = follow_sessions(spark, target, folder, buckets=8)
        expected = session_stats(live_events(spark, target))
        found = rollup_sessions(spark, folder).select(*expected.columns)
        assert same(found, expected)
        assert rollup_summary(spark, folder).first().num_sessions == expected.count()
    assert done is not None and follow_sessions(spark, target, folder) is None


def test_a_failed_update_leaves_the_rollup(spark, monkeypatch):
    events = generate_events(spark.range(500), events_per_session=5)
    folder = scratch_path(spark, "rollup")
    update_rollup(spark, folder, session_stats(events), buckets=4)

    def fails(self, rows):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("aislewise.plans.ledger.Ledger.publish", fails)
        with pytest.raises(OSError):
            update_rollup(spark, folder, session_stats(events))
    assert rollup_sessions(spark, folder).agg(F.sum("num_events")).first()[0] == 500


def test_sizes_for_a_hundred_terabytes():
    tb = 10**12
    # By session: every task hands on nearly all of its rows.
    plan = plan_aggregation(100 * tb, 780 * 10**9, 156 * 10**9, 96)
    assert plan.map_tasks * plan.partitions <= MOST_BLOCKS
    assert plan.shuffled_bytes > 70 * tb
    assert plan.split_bytes < 4 << 30 and plan.shuffled_bytes / plan.partitions < 4 << 30
    # By hour: the rows are combined away, whatever the input.
    few = plan_aggregation(100 * tb, 780 * 10**9, 96, 40)
    assert few.shuffled_bytes < 1 << 30 and few.partitions == 200 and few.map_tasks == 200_000
    # A laptop's input stays as it was.
    small = plan_aggregation(1 << 30, 8_000_000, 1_600_000, 96)
    assert small.map_tasks == 16 and small.partitions == 200 and small.split_bytes == 64 << 20
    assert plan_aggregation(0, 0, 0, 96).partitions == 200
    # More groups never make fewer partitions.
    sizes = [plan_aggregation(tb, 10**10, g, 96).partitions for g in (10, 10**6, 10**8, 10**10)]
    assert sizes == sorted(sizes)


def test_packing_moves_types_of_small_files_only(spark):
    events = generate_events(spark.range(6000), events_per_session=5)
    rare = events.where("event_type = 'cart'").limit(400)
    path = scratch_path(spark, "validated")
    write_validated(events.where("event_type <> 'cart'").coalesce(1), path)
    write_validated(rare.repartition(9), path, overwrite=False)
    before = set(spark.read.parquet(path).inputFiles())
    rows = stage(load_events(spark, path), "rows")
    assert pack_types(spark, path) == ["cart"]
    after = set(spark.read.parquet(path).inputFiles())
    assert len([f for f in before if "event_type=cart" in f]) == 9
    assert len([f for f in after if "event_type=cart" in f]) == 1
    assert {f for f in before if "cart" not in f} == {f for f in after if "cart" not in f}
    assert same(load_events(spark, path), rows)
    assert pack_types(spark, path) == []


def test_the_following_job_equals_the_whole_one(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(3):
        bought = [line.replace("view", "purchase") for line in lines_of(k, 4)]
        write(folder / f"{k}.csv", HEADER, *bought, *LINES)
    output = scratch_path(spark, "job")
    follow(spark, str(folder), output)
    (folder / "0.csv").unlink()
    write(folder / "9.csv", HEADER, *lines_of(9, 6))
    followed = follow(spark, str(folder), output)
    whole = run(spark, str(folder), scratch_path(spark, "job"), rejects=True, pack=True)
    for name in ("revenue_by_category", "conversion_funnel", "hourly_activity", "top_brands", "session_stats",
                 "product_sales", "product_rank", "rejects"):
        a, b = (spark.read.parquet(p[name]) for p in (followed, whole))
        assert same(a.select(*sorted(a.columns)), b.select(*sorted(b.columns))), name
    outcome = spark.read.parquet(followed["sync_outcome"]).first()
    assert (outcome.files_added, outcome.files_removed, outcome.files_kept, outcome.lines_read) == (1, 1, 2, 6)
