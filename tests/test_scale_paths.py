"""The distributed rank, median and sample against brute force, on skewed data."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aislewise import operators as op
from aislewise.operators.selection import exact_median
from tests.test_edges import event, table


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.just(0),
            st.integers(0, 50),
            st.integers(0, 2**45),
            st.integers(2**62, 2**62 + 3),
        ),
        max_size=30,
    )
)
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    known = [v for v in values if v is not None]
    got = exact_median(df, "v").first().median
    if not known:
        assert got is None
    else:
        assert got == pytest.approx(statistics.median(known), rel=1e-15)


def test_median_with_one_dominant_value(spark):
    values = [0] * 500 + list(range(1, 400)) + [2**42 + 5] * 200
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert exact_median(df, "v").first().median == statistics.median(values)


def rank_by_hand(sales):
    return {
        (c, p): 1 + sum(1 for (c2, _), s in sales.items() if c2 == c and s > score)
        for (c, p), score in sales.items()
    }


@pytest.mark.parametrize("spread", [3, 100_000, 50_000_000])
def test_rank_with_a_hot_category_and_ties(spark, spread):
    rng = random.Random(spread)
    sales, rows = {}, []
    for product in range(300):
        category = "hot" if product % 3 else f"c{product % 7}"
        cents = rng.randrange(1, spread)
        sales[category, product] = cents
        rows.append(
            event(
                event_type="purchase",
                product_id=product,
                category_code=f"{category}.x",
                price=cents / 100,
            )
        )
    expected = rank_by_hand(sales)
    df = table(spark, *rows)
    got = {(r.top_category, r.product_id): r["rank"] for r in op.product_rank(df).collect()}
    assert got == expected
    top = op.product_rank(df, top_n=4).collect()
    assert {(r.top_category, r.product_id): r["rank"] for r in top} == {
        key: rank for key, rank in expected.items() if rank <= 4
    }


@pytest.mark.parametrize("top_n", [1, 2, 3, 4, 9])
def test_first_ranks_keep_all_that_share_one(spark, top_n):
    prices = [9.0, 9.0, 7.0] + [5.0] * 200 + [3.0]
    rows = [
        event(event_type="purchase", product_id=i, price=price) for i, price in enumerate(prices)
    ]
    got = {r.product_id: r["rank"] for r in op.product_rank(table(spark, *rows), top_n=top_n).collect()}
    ranks = [1, 1, 3] + [4] * 200 + [204]
    assert got == {i: rank for i, rank in enumerate(ranks) if rank <= top_n}


def test_rank_by_number_of_purchases(spark):
    rows = [event(event_type="purchase", product_id=p) for p in (1, 1, 2, 3, 3, 4)]
    got = op.product_rank(table(spark, *rows), measure="num_purchases").collect()
    assert {r.product_id: r["rank"] for r in got} == {1: 1, 3: 1, 2: 3, 4: 3}
    with pytest.raises(ValueError):
        op.product_rank(table(spark, *rows), measure="clicks")


@pytest.mark.parametrize("size", [0, 1, 37, 300, 1000])
def test_sample_is_the_head_of_the_md5_order(spark, size):
    names = [f"s{i}" for i in range(300)]
    sessions = op.session_stats(table(spark, *[event(user_session=n) for n in names]))
    got = [r.user_session for r in op.session_sample(sessions, size).collect()]
    digest = {n: hashlib.md5(n.encode()).hexdigest() for n in names}
    assert got == sorted(names, key=digest.get)[:size]


def test_merged_rollups_of_batches_equal_the_whole(spark):
    start = dt.datetime(2019, 10, 1)
    rng = random.Random(7)
    rows = [
        event(
            event_time=start + dt.timedelta(microseconds=rng.randrange(10**12)),
            event_type=rng.choice(["view", "cart", "purchase"]),
            user_session="hot" if i % 3 == 0 else f"s{rng.randrange(40)}",
            price=float(rng.randrange(100)),
        )
        for i in range(600)
    ]
    whole = op.session_stats(table(spark, *rows))
    batches = [op.session_partials(table(spark, *rows[i::4])) for i in range(4)]
    united = batches[0]
    for batch in batches[1:]:
        united = united.unionByName(batch)
    merged = op.merge_session_partials(united)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_summary(spark):
    rows = [
        event(user_session=s, event_time=dt.datetime(2019, 10, 1, 0, m), price=2.0)
        for s, minutes in {"a": (0, 1), "b": (0, 5, 9), "c": (3,), "d": (0, 4)}.items()
        for m in minutes
    ]
    sessions = op.session_stats(table(spark, *rows))
    row = op.session_summary(sessions).first()
    assert tuple(row) == (4, 2.0, 2.5, 4.0)
    assert op.session_summary(sessions, approx=True).first().median_duration_min in (1.0, 4.0)
