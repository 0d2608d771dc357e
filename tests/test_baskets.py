"""Basket variant: calendar reconstruction, the blocked running sum, references, marts, the six files."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import baskets
from ordermill.operators.marts import BASKET_MARTS, build, present
from ordermill.operators.running import blocked_running_sum
from ordermill.plans.batch import basket_tables, csv_sink, run_baskets
from ordermill.schema import BASKET_FILES
from ordermill.sources import files

ORDERS = "order_id long, user_id long, eval_set string, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order {}"
LINES = "order_id long, product_id long, reordered int"
d = dt.date.fromisoformat


@pytest.mark.parametrize("kind", ["double", "string"])
def test_calendar_small_case(spark, kind):
    text = (lambda x: x) if kind == "double" else (lambda x: x if x is None else str(x))
    rows = [
        (11, 1, "prior", 1, 0, 8, None),
        (12, 1, "prior", 2, 1, 9, 15.0),
        (13, 1, "prior", 3, 2, 9, None),
        (14, 1, "train", 4, 3, 9, 30.0),
        (21, 2, "prior", 1, 0, 8, 7.0),  # a gap on the first order is ignored
        (22, 2, "prior", 2, 0, 8, 2.9),  # decimals truncate
    ]
    df = spark.createDataFrame([(*r[:6], text(r[6])) for r in rows], ORDERS.format(kind))
    got = {r.order_id: (r.order_date, r.sales_month) for r in baskets.order_calendar(df).collect()}
    assert got == {
        11: (d("2025-01-01"), d("2025-01-01")),
        12: (d("2025-01-16"), d("2025-01-01")),
        13: (d("2025-01-16"), d("2025-01-01")),
        14: (d("2025-02-15"), d("2025-02-01")),
        21: (d("2025-01-01"), d("2025-01-01")),
        22: (d("2025-01-03"), d("2025-01-01")),
    }
    assert baskets.unreadable_gaps(df).isEmpty()


def test_unreadable_gap_is_reported(spark):
    rows = [(1, 1, "prior", 1, 0, 8, "x"), (2, 1, "prior", 2, 0, 8, "soon"), (3, 1, "prior", 3, 0, 8, " ")]
    df = spark.createDataFrame(rows, ORDERS.format("string"))
    assert [(r.order_id, r.days_since_prior_order) for r in baskets.unreadable_gaps(df).collect()] == [(2, "soon")]


def test_blocked_running_sum_equals_window(spark):
    rnd = random.Random(7)
    rows = []
    for user in range(5):
        n = rnd.choice([1, 3, 50, 400])
        for pos in range(1, n + 1):
            for dup in range(rnd.choice([1, 1, 2])):
                rows.append((user if user else None, pos, pos * 10 + dup, rnd.randint(-5, 30)))
    df = spark.createDataFrame(rows, "g long, seq int, tie long, v long")
    got = blocked_running_sum(df, ["g"], "seq", ["tie"], "v", "run", block=7)
    w = Window.partitionBy("g").orderBy("seq", "tie").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("v").over(w))
    assert got.count() == df.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_blocked_count_numbers_a_hot_group_like_row_number(spark):
    # One (customer, day) holds most rows, with sparse unique keys spread over many blocks.
    rnd = random.Random(11)
    keys = rnd.sample(range(1, 20_000), 700)
    day = dt.date(2025, 1, 1)
    rows = [(1, day, k) for k in keys[:600]] + [(u, day, k) for u, k in zip([2, 2, 3, None], keys[600:604])]
    rows += [(4, dt.date(2025, 1, 2 + i % 3), k) for i, k in enumerate(keys[604:])]
    df = spark.createDataFrame(rows, "u long, d date, k long").withColumn("one", F.lit(1))
    got = blocked_running_sum(df, ["u", "d"], "k", [], "one", "n", block=16).drop("one")
    want = df.drop("one").withColumn("n", F.row_number().over(Window.partitionBy("u", "d").orderBy("k")).cast("long"))
    assert got.count() == len(rows)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.fixture
def six(spark):
    make = spark.createDataFrame
    return {
        "orders": make(
            [(1, 7, "prior", 1, 0, 8, None), (2, 7, "train", 2, 0, 8, "40.0"), (3, 8, "test", 1, 0, 8, None)],
            ORDERS.format("string"),
        ),
        "order_products__prior": make([(1, 100, 0), (1, 101, 0), (9, 100, 0)], LINES),
        "order_products__train": make([(2, 100, 1)], LINES),
        "products": make(
            [(100, "Milk", 1, 1), (101, "Eggs", 1, 2)],
            "product_id long, product_name string, aisle_id int, department_id int",
        ),
        "aisles": make([(1, "dairy")], "aisle_id int, aisle string"),
        "departments": make([(1, "fridge"), (2, "pantry")], "department_id int, department string"),
    }


def resolve(six):
    t = basket_tables(six)
    named = baskets.named_products(t["products"], t["aisles"], t["departments"])
    return baskets.resolved_lines(t["order_products"], baskets.order_calendar(t["orders"]), named)


def test_marts_of_resolved_lines(six):
    lines = baskets.basket_lines(resolve(six), strict=True)
    assert lines.count() == 3  # order 9 has no order row: skipped
    made = {n: present(n, build(baskets.mart_input(lines), m)).collect() for n, m in BASKET_MARTS.items()}
    assert [(str(r[0]), *r[1:4], float(r[4])) for r in made["basket_monthly"]] == [
        ("2025-01-01", 1, 1, 2, 2.0),
        ("2025-02-01", 1, 1, 1, 1.0),
    ]
    assert [(r.product_name, r.item_count, float(r.reorder_rate)) for r in made["basket_products"]] == [
        ("Milk", 2, 0.5),
        ("Eggs", 1, 0.0),
    ]
    assert [tuple(r) for r in made["basket_customers"]] == [(7, 2, 3, d("2025-01-01"), d("2025-02-10"), 2, True)]
    assert [tuple(r) for r in made["basket_category"]] == [("fridge", 2, 1, 2), ("pantry", 1, 1, 1)]
    f = made["basket_customer_features"][0]
    assert (f.user_id, f.order_count, f.item_count, float(f.avg_basket_lines), f.department_count) == (7, 2, 3, 1.5, 2)
    orders, union = six["orders"], basket_tables(six)["order_products"]
    assert [r.order_id for r in baskets.orders_without_lines(orders, union).collect()] == [3]


def test_unknown_references_are_named_or_fail(spark, six):
    six["products"] = spark.createDataFrame(
        [(100, "Milk", 1, 1), (101, "Eggs", 1, 5), (102, "Tea", 8, 1)],
        "product_id long, product_name string, aisle_id int, department_id int",
    )
    six["order_products__train"] = spark.createDataFrame([(2, 100, 1), (2, 102, 0), (2, 999, 0)], LINES)
    resolved = resolve(six)
    assert resolved.count() == 5
    got = {r.product_id: r.missing_reference for r in baskets.orphan_lines(resolved).collect()}
    assert got == {101: "department", 102: "aisle", 999: "product"}
    assert baskets.basket_lines(resolved).count() == 2
    with pytest.raises(ValueError, match="aisle 1, department 1, product 1"):
        baskets.basket_lines(resolved, strict=True)


def write_six(six, root):
    for name, df in six.items():
        if name.startswith("order_products"):
            df = df.withColumn("add_to_cart_order", F.lit(1))
        files.write_csv(df, f"{root}/{name}.csv")


def test_files_job_writes_sorted_marts(spark, six, scratch):
    write_six(six, scratch)
    back = files.read_baskets(spark, scratch)
    out = f"{scratch}/out"
    metrics = run_baskets(spark, basket_tables(back), csv_sink(out))
    assert metrics == {"lines": 3, "orphan_lines": 0, "unreadable_gaps": 0, "orders_without_lines": 1}
    names = [r.product_name for r in spark.read.option("header", True).csv(f"{out}/basket_products").collect()]
    assert names == ["Milk", "Eggs"]


def test_files_job_strict_and_lenient(spark, six, scratch):
    six["order_products__train"] = spark.createDataFrame([(2, 999, 0)], LINES)
    write_six(six, scratch)
    tables = basket_tables(files.read_baskets(spark, scratch))
    written = {}
    with pytest.raises(ValueError, match="product 1"):
        run_baskets(spark, tables, lambda tables: written.update({n: df.collect() for n, df in tables.items()}))
    assert written == {}
    run_baskets(spark, tables, lambda tables: written.update({n: df.collect() for n, df in tables.items()}), strict=False)
    assert [r.product_id for r in written["orphan_lines"]] == [999] and len(written["basket_products"]) == 2


def test_files_are_checked(spark, six, scratch):
    write_six(six, scratch)
    files.write_csv(six["aisles"].unionByName(six["aisles"]), f"{scratch}/aisles.csv")
    with pytest.raises(ValueError, match="aisle_id"):
        files.read_baskets(spark, scratch)
    files.write_csv(six["aisles"].select("aisle"), f"{scratch}/aisles.csv")
    with pytest.raises(ValueError, match="no column aisle_id"):
        files.read_baskets(spark, scratch)


def test_gaps_that_cannot_be_are_reported_and_add_nothing(spark):
    gaps = ["99999999", "-5", "2000000000000", "soon", "3660", "3661", None, "7.9"]
    rows = [(i + 1, 1, "prior", i + 1, 0, 0, g) for i, g in enumerate([None, *gaps])]
    orders = spark.createDataFrame(rows, BASKET_FILES["orders"])
    found = {r.days_since_prior_order for r in baskets.unreadable_gaps(orders).collect()}
    assert found == {"99999999", "-5", "2000000000000", "soon", "3661"}
    days = {r.order_number: str(r.order_date) for r in baskets.order_calendar(orders).collect()}
    assert days[5] == "2025-01-01" and days[6] == days[7] == "2035-01-09" and days[9] == "2035-01-16"


def test_dates_beyond_the_calendar_are_orphans(spark):
    rows = [(i, 1, "prior", i, 0, 0, "3660") for i in range(1, 900)]
    calendar = baskets.order_calendar(spark.createDataFrame(rows, BASKET_FILES["orders"]))
    last = calendar.filter("order_date is not null").agg({"order_date": "max"}).first()[0]
    assert last.year > 9980 and calendar.filter("order_date is null").count() > 50
    lines = spark.createDataFrame([(i, 5, 0, "prior") for i in (1, 899)], "order_id long, product_id long, reordered int, split string")
    named = spark.createDataFrame([(5, "p", "a", "d", None)], "product_id long, product_name string, aisle string, department string, missing string")
    resolved = baskets.resolved_lines(lines, calendar, named)
    assert [tuple(r) for r in baskets.orphan_lines(resolved).collect()] == [("prior", 899, 5, "order_date")]
    assert [r.order_id for r in baskets.basket_lines(resolved).collect()] == [1]
