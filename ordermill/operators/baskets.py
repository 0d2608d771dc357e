"""Basket-volume variant over normalised tables (orders, order products, products,
aisles, departments), which carry no prices: every order product counts as one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import blank, parse_truncated_int
from .running import blocked_running_sum

# First order date of every customer's reconstructed calendar (fixed value).
CALENDAR_START = "2025-01-01"

# Longest gap between two orders that counts as one, in days, and last day of the calendar.
MAX_GAP_DAYS = 3660
LAST_DAY = "9999-12-31"

# Columns of a resolved basket line (fixed values of the input format, with the calendar's columns).
LINE_COLUMNS = [
    "split", "order_id", "user_id", "eval_set", "product_id", "product_name", "aisle", "department",
    "reordered", "order_date", "sales_month",
]


def with_gap_days(orders: DataFrame) -> DataFrame:
    """Adds ``gap_days``: whole days (decimals truncated) from the customer's order before, 0 on the first order
    and where no gap is given, NULL where a gap is given that is no number from 0 to MAX_GAP_DAYS. Gaps may be text
    or numbers."""
    text = F.col("days_since_prior_order").cast("string")
    days = parse_truncated_int(text)
    return orders.withColumn(
        "gap_days",
        F.when((F.col("order_number") == 1) | blank(F.trim(text)), F.lit(0)).when(days.between(0, MAX_GAP_DAYS), days),
    )


def unreadable_gaps(orders: DataFrame) -> DataFrame:
    """Orders whose gap is given but is no number of days that can be: the dates of that customer's later orders
    rest on it."""
    return with_gap_days(orders).filter(F.col("gap_days").isNull()).drop("gap_days")


def order_calendar(orders: DataFrame) -> DataFrame:
    """Rebuild each order's date from day gaps: every customer starts on CALENDAR_START and each later order
    adds its gap, in order_number order. An unreadable gap adds nothing; ``unreadable_gaps`` reports them,
    and ``check_references`` callers treat them as faults. A date after LAST_DAY is NULL; lines of such an order are
    orphans."""
    with_gap = with_gap_days(orders).withColumn("gap_days", F.coalesce("gap_days", F.lit(0)))
    summed = blocked_running_sum(with_gap, ["user_id"], "order_number", ["order_id"], "gap_days", "day")
    return summed.select(
        "order_id",
        "user_id",
        "eval_set",
        "order_number",
        "order_dow",
        "order_hour_of_day",
        calendar_date(F.col("day")).alias("order_date"),
        F.trunc(calendar_date(F.col("day")), "month").alias("sales_month"),
    )


def calendar_date(day: Column) -> Column:
    """The date that many days after CALENDAR_START, NULL after LAST_DAY."""
    start = F.lit(CALENDAR_START).cast("date")
    fits = day <= F.datediff(F.lit(LAST_DAY).cast("date"), start)
    return F.when(fits, F.date_add(start, F.when(fits, day).cast("int")))


def union_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Both order-product files as one frame with a ``split`` column."""
    return prior.withColumn("split", F.lit("prior")).unionByName(train.withColumn("split", F.lit("train")))


def require_unique(dim: DataFrame, key: str) -> DataFrame:
    """Fail when a dimension key repeats: 'last row wins' has no meaning on a split read."""
    dup = dim.groupBy(key).count().filter(F.col("count") > 1)
    if not dup.isEmpty():
        raise ValueError(f"duplicate {key} values in dimension")
    return dim


def named_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with aisle, department and ``missing``: the first reference that does not resolve, or NULL."""
    aisle = aisles.select("aisle_id", "aisle", F.lit(True).alias("has_aisle"))
    department = departments.select("department_id", "department", F.lit(True).alias("has_department"))
    return (
        products.join(aisle, "aisle_id", "left")
        .join(department, "department_id", "left")
        .select(
            "product_id",
            "product_name",
            "aisle",
            "department",
            F.when(F.col("has_department").isNull(), F.lit("department"))
            .when(F.col("has_aisle").isNull(), F.lit("aisle"))
            .alias("missing"),
        )
    )


def resolved_lines(
    order_products: DataFrame, calendar: DataFrame, named: DataFrame, parts: int | None = None
) -> DataFrame:
    """Order products of known orders (others are skipped), with calendar, names and ``missing``: the reference
    (product, department, aisle or a date within the calendar) that does not resolve, NULL where all do. No line is lost on the way.

    ``parts``, taken from the number of lines, bounds the lines a task joins. Without it the session's shuffle
    settings do, which go by packed bytes: of lines that pack well, one task gets many times its memory."""
    known = named.withColumn("has_product", F.lit(True))
    cut = (lambda rows, key: rows.repartition(parts, key)) if parts else (lambda rows, key: rows)
    dated = cut(order_products, "order_id").join(
        calendar.select("order_id", "user_id", "eval_set", "order_date", "sales_month"), "order_id"
    )
    return (
        cut(dated, "product_id")
        .join(known, "product_id", "left")
        .withColumn(
            "missing",
            F.when(F.col("has_product").isNull(), F.lit("product"))
            .when(F.col("missing").isNotNull(), F.col("missing"))
            .when(F.col("order_date").isNull(), F.lit("order_date")),
        )
        .select(*LINE_COLUMNS, "missing")
    )


def orphan_lines(resolved: DataFrame) -> DataFrame:
    """Lines with an unknown product, department, aisle or date, and which of them."""
    return resolved.filter(F.col("missing").isNotNull()).select(
        "split", "order_id", "product_id", F.col("missing").alias("missing_reference")
    )


def basket_lines(resolved: DataFrame, strict: bool = False) -> DataFrame:
    """Lines of which every reference resolves.

    ``strict`` fails when any line has an unknown product, department or aisle;
    otherwise those lines are left to ``orphan_lines`` (the quarantine).
    """
    if strict:
        found = orphan_lines(resolved).groupBy("missing_reference").count().collect()
        if found:
            raise ValueError(
                "lines with unknown references: "
                + ", ".join(f"{r.missing_reference} {r['count']}" for r in sorted(found))
            )
    return resolved.filter(F.col("missing").isNull()).select(*LINE_COLUMNS)


def require_references(order_products: DataFrame, calendar: DataFrame, named: DataFrame) -> None:
    """Fail as ``basket_lines`` does in strict mode. Where every product that is bought resolves and every order has a
    date, no line can be an orphan; the lines are resolved and counted only if that is not so."""
    bought = order_products.select("product_id").distinct()
    known = named.select("product_id", F.coalesce("missing", F.lit("none")).alias("missing"))
    doubtful = bought.join(known, "product_id", "left").filter(~F.col("missing").eqNullSafe("none"))
    if not (calendar.filter(F.col("order_date").isNull()).isEmpty() and doubtful.isEmpty()):
        basket_lines(resolved_lines(order_products, calendar, named), strict=True)


def orders_without_lines(orders: DataFrame, order_products: DataFrame) -> DataFrame:
    return orders.join(order_products.select("order_id"), "order_id", "left_anti")


def mart_input(lines: DataFrame) -> DataFrame:
    """Basket lines with the columns the measures read: one item each."""
    return lines.select(
        "order_id", "user_id", "product_id", "product_name", "department", "order_date", "sales_month",
        F.lit(1).alias("quantity"), F.coalesce("reordered", F.lit(0)).alias("is_reordered"),
    )
