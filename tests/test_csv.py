"""CSV scan, rejects, discovery and sampling on hand-written files."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aislewise.operators import clean_events, compare_schema, top_brands
from aislewise.plans import ingest
from aislewise.schema import RAW
from aislewise.sinks import write_events_csv
from aislewise.sources import (
    discover_inputs,
    generate_events,
    sample_csv,
    scan_csv,
    scan_rejects,
    write_synthetic_csv,
)
from aislewise.sources.csv_records import quoted_records
from aislewise.sources.files import list_files, literal, read_headers, text_lines
from aislewise.workspace import scratch_path
from checks import queries, tables

HEADER = ",".join(RAW.names)
GOOD = "2019-10-01 00:00:05 UTC,view,1,2053013555631882655,electronics.audio,lg,1.50,5,abc"
# FIXTURES.md section 3.
LINES = [
    GOOD,
    "2019-10-01 00:00:05 UTC,view,1,2053013555631882655,,,1.50,5,abc",
    GOOD + ",more",
    "2019-10-01 00:00:05 UTC,view,1,2053013555631882655,x",
    "2019-10-01 00:00:05 UTC,view,one,2053013555631882655,,,1.50,5,abc",
    "2019-10-01 00:00:05 UTC,view,1,2053013555631882655,,NA,NaN,5,\t ",
    "2019-10-01 00:00:05 UTC,refund,1,2053013555631882655,,,-1,5,abc",
]


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_malformed_lines_do_not_depend_on_the_columns_used(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *LINES)
    good = scan_csv(spark, path)
    assert good.count() == 4
    assert len(good.collect()) == 4
    assert len(good.select("event_type").collect()) == 4
    assert good.groupBy("event_type").count().agg(F.sum("count")).first()[0] == 4
    assert good.schema == RAW
    assert clean_events(good).count() == 2
    rejects = scan_rejects(spark, path).collect()
    assert sorted(r.line for r in rejects) == sorted(LINES[2:5])
    assert {r.source_file for r in rejects} == {"a.csv"}


def test_each_line_is_parsed_once(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *LINES)
    clean = clean_events(scan_csv(spark, path))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1


def test_values(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        HEADER,
        GOOD,
        "",
        "   ",
        '2019-10-01 00:00:05.25 UTC,view,1,2053013555631882655,"","a ""b"", c\\",1e3,5,abc',
        "2019-10-01 00:00:05,view,,,,NA,1.5,5,",
    )
    rows = scan_csv(spark, path).collect()
    assert len(rows) == 3
    by_brand = {r.brand: r for r in rows}
    assert by_brand["lg"].event_time == dt.datetime(2019, 10, 1, 0, 0, 5)
    assert by_brand["lg"].category_id == 2053013555631882655
    quoted = by_brand['a "b", c\\']
    assert quoted.event_time == dt.datetime(2019, 10, 1, 0, 0, 5, 250_000)
    assert quoted.category_code is None and quoted.price == 1000.0
    assert by_brand["NA"].product_id is None and by_brand["NA"].user_session is None


def test_columns_follow_the_header(spark, tmp_path):
    header = "price,event_type,event_time,note"
    path = write(tmp_path / "a.csv", "\ufeff" + header, "2.5,cart,2019-10-01 01:02:03 UTC,hi")
    df = scan_csv(spark, path)
    assert df.columns == header.split(",")
    row = df.first()
    assert (row.price, row.event_type, row.note) == (2.5, "cart", "hi")
    found = compare_schema(df)
    assert not found.valid and found.extra == ["note"] and "brand" in found.missing


def test_several_files_are_one_table(spark, tmp_path):
    first = write(tmp_path / "2019-Oct.csv", HEADER, GOOD)
    second = write(tmp_path / "2019-Nov.csv", HEADER, GOOD, GOOD)
    write(tmp_path / "other.csv", HEADER, GOOD)
    assert scan_csv(spark, [first, second]).count() == 3
    assert scan_csv(spark, str(tmp_path), pattern="2019-*.csv").count() == 3


def test_discovery(spark, tmp_path):
    assert discover_inputs(spark, str(tmp_path / "absent")) == []
    write(tmp_path / "2019-Nov.csv", HEADER, GOOD)
    write(tmp_path / "other.csv", HEADER, GOOD)
    assert [p.rsplit("/", 1)[-1] for p in discover_inputs(spark, str(tmp_path))] == ["2019-Nov.csv"]
    write(tmp_path / "2019-Oct.csv", HEADER, GOOD)
    names = [p.rsplit("/", 1)[-1] for p in discover_inputs(spark, str(tmp_path))]
    assert names == ["2019-Oct.csv", "2019-Nov.csv"]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield 4096
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sample_is_the_head_of_the_first_file(spark, tmp_path, small_splits):
    body = [GOOD.replace(",1,", f",{i},", 1) for i in range(500)]
    path = write(tmp_path / "2019-Nov.csv", HEADER, *body)
    write(tmp_path / "2019-Oct.csv", HEADER, GOOD)
    got = sample_csv(spark, str(tmp_path), blocks=2, block_bytes=small_splits)
    # A line belongs to the split that it starts in; one that starts exactly on
    # the border is read with the split before.
    start, expected = len(HEADER) + 1, []
    for i, line in enumerate(body):
        if start <= 2 * small_splits:
            expected.append(i)
        start += len(line) + 1
    assert sorted(r.product_id for r in got.collect()) == expected
    assert 0 < len(expected) < len(body)
    assert sample_csv(spark, path).count() == len(body)


def with_splits(spark, size, act):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        return act()
    finally:
        spark.conf.set(key, before)


def test_the_cut_of_a_sample_is_exact_and_takes_few_tasks(spark, tmp_path):
    body = [GOOD.replace(",1,", f",{i},", 1) for i in range(1000)]
    path = write(tmp_path / "a.csv", HEADER, *body)
    starts = [len(HEADER) + 1]
    for line in body:
        starts.append(starts[-1] + len(line) + 1)
    expected = [i for i in range(1000) if starts[i] <= 1024]

    def sample():
        got = sample_csv(spark, path, blocks=2, block_bytes=512)
        return sorted(r.product_id for r in got.collect()), got.rdd.getNumPartitions()

    # The split does not divide the block, and the file has 260 of them.
    found, tasks = with_splits(spark, 300, sample)
    assert found == expected and 0 < len(expected) < 20
    assert tasks < 50


def test_small_splits_of_quoted_breaks_share_tasks(spark, tmp_path):
    text, brands = broken_lines(5, 400)
    (tmp_path / "a.csv").write_text(text)

    def scan():
        records = quoted_records(text_lines(spark, str(tmp_path)), tasks=4)
        got = scan_csv(spark, str(tmp_path), multiline=True)
        rows = sorted(((r.product_id, r.brand) for r in got.collect()), key=str)
        return records.count(), rows, got.rdd.getNumPartitions()

    records, rows, tasks = with_splits(spark, 64, scan)
    assert records == 401
    assert rows == sorted(brands, key=str)
    # As many scan tasks as twice the cores, and the shuffle of stitched ends; the file has over 300 splits.
    assert tasks <= 3 * spark.sparkContext.defaultParallelism


def test_the_writer_of_a_sampled_file_joins_nothing(spark, tmp_path, monkeypatch):
    events = [(i, dt.datetime(2019, 10, 1), i % 9, "view", 1.5, '{"k": %d}' % (i % 3)) for i in range(40)]
    frame = spark.createDataFrame(events, tables.EVENTS)
    frame.write.parquet(str(tmp_path / "events.parquet"))
    parts = spark.createDataFrame([(k, f"n{k}", f"b{k}", "T") for k in range(3)], tables.PART)
    parts.write.parquet(str(tmp_path / "part.parquet"))
    plans = []

    def copy(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return tables.csv_copy(df)

    monkeypatch.setattr(queries, "csv_copy", copy)
    found = queries.sample_head(spark, str(tmp_path))
    assert found.count() == 20
    assert len(plans) == 4 and not any("Join" in p for p in plans)


def test_synthetic_file(spark, tmp_path):
    path = str(tmp_path / "made")
    write_synthetic_csv(spark, path, size_mb=1)
    df = scan_csv(spark, path)
    rows = df.count()
    size = sum(f.stat().st_size for f in (tmp_path / "made").glob("*.csv"))
    assert 0.9 < size / 2**20 < 1.1
    assert clean_events(df).count() == rows
    low_high = df.agg(
        F.min("price"), F.max("price"), F.min("category_id"), F.max("category_id"),
        F.min("product_id"), F.max("product_id"), F.count_distinct("event_type"),
        F.count_distinct("brand"), F.count_distinct("category_code"),
    ).first()
    assert 10 <= low_high[0] <= low_high[1] <= 2000
    assert 2 * 10**18 <= low_high[2] <= low_high[3] <= 3 * 10**18
    assert 1_000 <= low_high[4] <= low_high[5] <= 9_999_999
    assert low_high[6:] == (4, 6, 4)


def test_synthetic_events_depend_on_id_and_seed_only(spark):
    once = generate_events(spark.range(2000, numPartitions=2))
    again = generate_events(spark.range(2000, numPartitions=7))
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    other = generate_events(spark.range(2000), seed=1)
    assert other.select("price", "user_id").exceptAll(once.select("price", "user_id")).count() > 1900
    shared = generate_events(spark.range(2000), events_per_session=4)
    assert shared.select("user_session").distinct().count() == 500


# Any text without line breaks and null characters.
TEXT = st.text(
    st.characters(exclude_categories=["Cs", "Cc", "Zl", "Zp"], include_characters="\t"), max_size=8
)
FIELD = st.one_of(st.none(), TEXT, st.sampled_from([" ", '"', '""', ",", "\\", 'a\\"', "NA", "#x"]))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(FIELD, FIELD, FIELD, st.floats(allow_nan=False)), min_size=1, max_size=20))
def test_text_and_numbers_survive_a_round_trip(spark, rows):
    time = dt.datetime(2019, 10, 1, 0, 0, 5)
    events = [
        (time, "view", i, 2 * 10**18, code, brand, price, 5, session)
        for i, (code, brand, session, price) in enumerate(rows)
    ]
    df = spark.createDataFrame(events, RAW)
    path = scratch_path(spark, "csv")
    write_events_csv(df, path)
    # An empty text cannot be told from a missing one.
    expected = {e[2]: tuple(None if v == "" else v for v in e) for e in events}
    assert {r.product_id: tuple(r) for r in scan_csv(spark, path).collect()} == expected


def test_each_file_has_its_own_header(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, GOOD)
    names = list(RAW.names)
    i, j = names.index("category_code"), names.index("brand")
    names[i], names[j] = names[j], names[i]
    write(tmp_path / "b[1].csv", "\ufeff" + ",".join(names) + ",note", GOOD + ",hi")
    write(tmp_path / "c d%20.csv", "", "  ", HEADER, GOOD, GOOD)
    write(tmp_path / "empty.csv", "", "")
    rows = scan_csv(spark, str(tmp_path)).collect()
    assert Counter((r.category_code, r.brand, r.note) for r in rows) == {
        ("electronics.audio", "lg", None): 3, ("lg", "electronics.audio", "hi"): 1
    }
    for name, n in (("a.csv", 1), ("b[1].csv", 1), ("c d%20.csv", 2)):
        one = {r.uri.rsplit("/", 1)[-1]: r.path for r in list_files(spark, str(tmp_path)).collect()}
        path = next(p for p in one.values() if p.endswith(name))
        assert scan_csv(spark, literal(path)).count() == n
        assert sample_csv(spark, literal(path)).count() == n


def test_headers_of_many_splits(spark, tmp_path, small_splits):
    body = [GOOD] * 300
    for k in range(3):
        write(tmp_path / f"{k}.csv", HEADER + f",x{k}", *[f"{line},{k}" for line in body])
    write(tmp_path / "small.csv", HEADER, GOOD)
    headers = read_headers(spark, str(tmp_path))
    assert {u.rsplit("/", 1)[-1]: h for u, h in headers.items()} == {
        "small.csv": HEADER, **{f"{k}.csv": f"{HEADER},x{k}" for k in range(3)}
    }
    found = scan_csv(spark, str(tmp_path))
    assert found.count() == 901
    assert {r.x1: r["count"] for r in found.groupBy("x1").count().collect()} == {None: 601, "1": 300}


def broken_lines(seed, n):
    """CSV text whose brands hold line breaks, quotes and commas, and the brands."""
    rnd = random.Random(seed)
    text, brands = [], []
    for i in range(n):
        brand = "".join(rnd.choice(['\n', '"', ",", "a", "b ", "\n\n", "é"]) for _ in range(rnd.randint(0, 12)))
        if rnd.random() < 0.5:
            brand = "plain"
        brands.append((i, brand or None))
        quoted = '"' + brand.replace('"', '""') + '"' if set(brand) & set('\n",') or rnd.random() < 0.3 else brand
        text.append(f"2019-10-01 00:00:05 UTC,view,{i},5,,{quoted},1.50,5,abc")
    return "\n".join([HEADER, *text]) + "\n", brands


@pytest.mark.parametrize("size", [64, 333, 4096])
def test_line_breaks_in_quotes_across_splits(spark, tmp_path, size):
    expected = []
    for k in range(3):
        text, brands = broken_lines(k, 120)
        (tmp_path / f"{k}.csv").write_text(text)
        expected += brands
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        scan = scan_csv(spark, str(tmp_path), multiline=True)
        found = [(r.product_id, r.brand) for r in scan.collect()]
    finally:
        spark.conf.set(key, before)
    trimmed = [(i, b if b is None else b) for i, b in expected]
    assert sorted(found, key=str) == sorted(trimmed, key=str)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, GOOD, GOOD.replace("lg", '"lg'), GOOD, GOOD)
    assert scan_csv(spark, path, multiline=True).count() == 1
    [reject] = scan_rejects(spark, path, multiline=True).collect()
    assert reject.line.count("\n") == 2
    lines = text_lines(spark, path)
    with pytest.raises(Exception, match="not closed within 100 bytes"):
        quoted_records(lines, most_bytes=100).collect()


def test_sample_goes_on_to_the_next_file(spark, tmp_path):
    for k in range(3):
        write(tmp_path / f"{k}.csv", HEADER, GOOD.replace(",5,abc", f",{k},abc"))
    assert sorted(r.user_id for r in sample_csv(spark, str(tmp_path)).collect()) == [0, 1]
    given = [str(tmp_path / f"{k}.csv") for k in (2, 0, 1)]
    assert sorted(r.user_id for r in sample_csv(spark, given).collect()) == [0, 2]


def test_other_inputs_are_ingested_again(spark, tmp_path):
    for name, rows in (("a", 1), ("b", 3)):
        (tmp_path / name).mkdir()
        write(tmp_path / name / "x.csv", HEADER, *[GOOD] * rows)
    target = scratch_path(spark, "target")
    assert ingest(spark, str(tmp_path / "a"), target).rows_written == 1
    assert ingest(spark, str(tmp_path / "a"), target).skipped
    assert ingest(spark, str(tmp_path / "b"), target).rows_written == 3


def test_brands_of_equal_cents_go_by_name(spark):
    rows = [("b", 0.1), ("b", 0.2), ("a", 0.3)]
    bought = spark.createDataFrame(rows, "brand string, price double").withColumn(
        "event_type", F.lit("purchase")
    )
    assert [r.brand for r in top_brands(bought, 1).collect()] == ["a"]
