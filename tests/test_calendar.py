"""Incremental calendar: increments equal the full rebuild; only late customers are made anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import baskets
from ordermill.schema import BASKET_FILES
from ordermill.streaming import calendar
from ordermill.streaming.commits import StreamTables


def orders(spark, rows):
    return spark.createDataFrame(rows, BASKET_FILES["orders"])


def sample():
    rnd = random.Random(8)
    rows, order = [], 0
    for user in [*range(12), None]:
        for number in range(1, rnd.randrange(2, 14)):
            order += 1
            gap = None if number == 1 else rnd.choice(["0", "3.0", "30", "x", "-2", None])
            rows.append((order, user, "prior", number, 1, 2, gap))
    rows += [(900, 3, "prior", None, 1, 2, "4"), (901, 3, "prior", 2, 1, 2, "5"), (902, 5, "prior", 1, 1, 2, "9")]
    return rows


def same(x, y):
    return sorted(map(str, x.collect())) == sorted(map(str, y.collect()))


@pytest.mark.parametrize("how", ["in order", "mixed"])
def test_three_increments_equal_the_rebuild(spark, scratch, how):
    rows = sample()
    part = (lambda r: min(2, (r[3] or 1) // 4)) if how == "in order" else (lambda r: r[0] % 3)
    store, seen = StreamTables(spark, scratch), []
    for number in range(3):
        some = [r for r in rows if part(r) == number]
        seen += some
        calendar.add_orders(store, orders(spark, some), number)
        got, want = calendar.read_calendar(spark, scratch), baskets.order_calendar(orders(spark, seen))
        assert got.columns == want.columns and same(got, want)
    calendar.add_orders(store, orders(spark, rows), 2)  # committed before
    assert same(calendar.read_calendar(spark, scratch), baskets.order_calendar(orders(spark, rows)))


def test_only_late_customers_are_made_anew(spark, scratch):
    store = StreamTables(spark, scratch)
    calendar.add_orders(store, orders(spark, [(u * 10 + n, u, "prior", n, 0, 0, "2") for u in (1, 2) for n in (1, 2, 3)]), 0)
    calendar.add_orders(store, orders(spark, [(14, 1, "prior", 4, 0, 0, "2"), (29, 2, "prior", 2, 0, 0, "7")]), 1)
    written = store.read(calendar.CALENDAR).filter("batch_id = 1").groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in written} == {1: 1, 2: 4}
    since = {r.user_id: (r.since, r.last_day) for r in calendar._newest(store.read(calendar.USERS)).collect()}
    assert since == {1: (0, 6), 2: (1, 11)}
    assert calendar.read_calendar(spark, scratch).filter(F.col("user_id") == 2).count() == 4


def test_nothing_before_the_first_increment(spark, scratch):
    assert calendar.read_calendar(spark, scratch).count() == 0
