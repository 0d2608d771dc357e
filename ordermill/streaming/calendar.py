"""The order calendar kept up to date as orders arrive.

An order's date is the sum of the day gaps of its customer's orders up to it. The
state of a customer is the last order number and the day it fell on: a later
order goes on from there, without a look at earlier ones. An order that comes late
(its number isn't beyond the customer's last) moves the dates after it, so the
calendar of that customer, and of no other, is made anew from all their orders.

Tables (``commits``): the orders as they came; calendar rows with their batch; and
per customer the last number, the last day and ``since``, the batch from which the
customer's calendar rows count. Each increment is one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from ..operators.baskets import calendar_date, with_gap_days
from ..operators.running import blocked_running_sum
from ..schema import BASKET_FILES
from .commits import StreamTables, Table, Version

ORDERS = Table("orders", BASKET_FILES["orders"], lambda rows: rows)
_FIELDS = [f for f in BASKET_FILES["orders"].fields if f.name != "days_since_prior_order"]
CALENDAR = Table(
    "calendar",
    StructType([*_FIELDS, *(StructField(c, DateType()) for c in ("order_date", "sales_month")), StructField("batch_id", LongType())]),
    lambda rows: rows,
)
_USER_COLUMNS = ["user_id", "last_number", "last_day", "since", "batch_id"]


def _newest(rows: DataFrame) -> DataFrame:
    """The last state of each customer; one without an id is a customer too."""
    return rows.groupBy("user_id").agg(F.max_by(F.struct(*_USER_COLUMNS), "batch_id").alias("row")).select("row.*")


USERS = Table("users", StructType([StructField(c, LongType()) for c in _USER_COLUMNS]), _newest)


def _same_user(a: DataFrame, b: DataFrame):
    return a["user_id"].eqNullSafe(b["user_id"])


def _with_days(orders: DataFrame) -> DataFrame:
    """Orders with ``day``: the running sum of their gaps, by customer."""
    gaps = with_gap_days(orders).withColumn("gap_days", F.coalesce("gap_days", F.lit(0)))
    return blocked_running_sum(gaps, ["user_id"], "order_number", ["order_id"], "gap_days", "day").drop("gap_days")


def add_orders(store: StreamTables, orders: DataFrame, batch: int) -> Version:
    """One increment; a batch that was committed before adds nothing."""
    base = store.live()
    if batch <= base.batch:
        return base
    segment = store.write(ORDERS, orders)
    new = store.segment(ORDERS, segment)
    # An order without a number stands before all others.
    first = new.groupBy("user_id").agg(F.min(F.coalesce("order_number", F.lit(0))).alias("first_number"))
    state = _newest(store.read(USERS, base)).withColumnRenamed("user_id", "known_user").drop("batch_id")
    heads = store.stage(first.join(state, F.col("user_id").eqNullSafe(F.col("known_user")), "left"))
    known = F.col("last_number").isNotNull()
    late = heads.filter(known & (F.col("first_number") <= F.col("last_number"))).select("user_id")
    ahead = heads.filter(~known | (F.col("first_number") > F.col("last_number")))

    before = store.read(ORDERS, base)
    again = before.join(late, _same_user(before, late), "left_semi").unionByName(new.join(late, _same_user(new, late), "left_semi"))
    redone = _with_days(again).withColumn("since", F.lit(batch).cast("long"))
    going_on = _with_days(new.join(ahead, _same_user(new, ahead), "left_semi")).alias("o")
    offsets = ahead.select(
        "user_id", F.coalesce("last_day", F.lit(0)).alias("offset"), F.coalesce("since", F.lit(batch).cast("long")).alias("since")
    ).alias("h")
    moved = going_on.join(offsets, F.col("o.user_id").eqNullSafe(F.col("h.user_id"))).select(
        *[F.col(f"o.{f.name}") for f in BASKET_FILES["orders"].fields],
        (F.col("o.day") + F.col("h.offset")).alias("day"),
        F.col("h.since").alias("since"),
    )
    dated = store.stage(redone.select(moved.columns).unionByName(moved))

    number = F.lit(batch).cast("long").alias("batch_id")
    day = calendar_date(F.col("day"))
    rows = dated.select(
        *[f.name for f in _FIELDS], day.alias("order_date"), F.trunc(day, "month").alias("sales_month"), number
    )
    users = dated.groupBy("user_id").agg(
        F.max(F.coalesce("order_number", F.lit(0))).cast("long").alias("last_number"),
        F.max("day").cast("long").alias("last_day"),
        F.min("since").alias("since"),
    )
    added = {
        ORDERS.name: segment,
        CALENDAR.name: store.write(CALENDAR, rows),
        USERS.name: store.write(USERS, users.withColumn("batch_id", number)),
    }
    return store.commit(batch, base, [ORDERS, CALENDAR, USERS], added)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    """The calendar of all committed increments."""
    store = StreamTables(spark, root)
    version = store.live()
    rows = store.read(CALENDAR, version).alias("c")
    users = _newest(store.read(USERS, version)).select("user_id", "since").alias("u")
    counts = F.col("c.user_id").eqNullSafe(F.col("u.user_id")) & (F.col("c.batch_id") >= F.col("u.since"))
    return rows.join(users, counts, "left_semi").drop("batch_id")
