"""Map the driver's TPC-H-style tables onto the order-line data model.

order line        <- lineitem JOIN orders JOIN part
  order_id          l_orderkey
  user_id           o_custkey
  product_id        l_partkey
  product_name      p_name
  aisle             p_type
  department        p_brand
  quantity          int(l_quantity)
  unit_price        decimal(p_retailprice)
  order_date        date(o_orderdate)
  order_number      position of the order in the customer's history, ordered by (date, order key)
  days_since_prior  least(30, days since the customer's previous order); NULL on the first order
  reordered         1 when the customer bought the product on an earlier date

The normalised basket tables come from the same rows: orders with status 'P'
form the ``train`` split, all others ``prior``; aisles and departments get
dense ids in name order. ``build_baskets`` writes the orders with their sequence
once to the shared work folder.

Every column is derived with joins and aggregations; orders of one customer and
day are numbered in blocks of order ids, and the per-customer window runs over
one row per (customer, day, block), so no task holds all orders of a customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parse import PRICE
from ..schema import ORDER_COLUMNS
from ..session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Order lines that a task joins.
LINES_A_TASK = 250_000


def line_parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts of at most about LINES_A_TASK lines; the count comes from the files' own figures."""
    return max(1, -(-table(spark, sf_dir, "lineitem").count() // LINES_A_TASK))


SEQUENCE_COLUMNS = ["order_number", "days_since_prior_order"]


def base_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        F.hour("o_orderdate").cast("int").alias("order_hour_of_day"),
    )


#: Order ids that share a block when one customer's orders of one day are numbered.
ID_BLOCK = 4096


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the customer-sequence columns.

    A customer's orders are numbered by (day, order id): inside one (customer, day,
    block of order ids) by a window over at most ID_BLOCK orders, across them by a
    window over one row per such block. The block sums come from the same exchange.
    """
    block = ["user_id", "order_date", "id_block"]
    orders = base_orders(spark, sf_dir).withColumn("id_block", F.floor(F.col("order_id") / ID_BLOCK))
    local = orders.withColumn("place", F.row_number().over(Window.partitionBy(*block).orderBy("order_id")))
    of_user = Window.partitionBy("user_id").orderBy("order_date", "id_block")
    blocks = (
        local.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(
            *block,
            F.coalesce(F.sum("orders").over(of_user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
            F.lag("order_date").over(of_user).alias("date_before"),
        )
    )
    # In a block's first place the order before is the last of the block before; elsewhere it is of the same day.
    gap = F.when(F.col("place") > 1, F.lit(0)).otherwise(F.datediff("order_date", "date_before"))
    return local.join(blocks, block).select(
        "order_id",
        "user_id",
        "order_status",
        (F.col("before") + F.col("place")).cast("int").alias("order_number"),
        "order_dow",
        "order_hour_of_day",
        F.when(gap.isNotNull(), F.least(F.lit(30), gap)).cast("int").alias("days_since_prior_order"),
        "order_date",
    )


def purchases(spark: SparkSession, sf_dir: str, sequence: bool = True) -> DataFrame:
    """Line items with their order's customer columns and the ``reordered`` flag.

    ``sequence=False`` leaves out order_number and days_since_prior_order, which
    need a per-customer pass over all orders; callers that never read them skip it.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    orders = customer_orders(spark, sf_dir) if sequence else base_orders(spark, sf_dir)
    bought = lines.join(orders, "order_id")
    first = bought.groupBy("user_id", "product_id").agg(F.min("order_date").alias("first_bought"))
    # Every (user, product) of ``bought`` has its row in ``first``, so a left join
    # keeps the same lines; unlike an inner join, Catalyst removes it (aggregate
    # and exchanges included) from plans that never read ``reordered``.
    return bought.join(first, ["user_id", "product_id"], "left").withColumn(
        "reordered", (F.col("order_date") > F.col("first_bought")).cast("int")
    ).drop("first_bought")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("aisle"),
        F.col("p_brand").alias("department"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
    )


def order_lines(spark: SparkSession, sf_dir: str, sequence: bool = True) -> DataFrame:
    """Typed denormalised order lines (the batch job's input).

    With ``sequence=False`` the two sequence columns are NULL (see ``purchases``).
    """
    rows = purchases(spark, sf_dir, sequence).join(products(spark, sf_dir), "product_id")
    if not sequence:
        rows = rows.select("*", *[F.lit(None).cast("int").alias(c) for c in SEQUENCE_COLUMNS])
    return rows.select(*ORDER_COLUMNS)


def faulted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text, the way a CSV feed delivers them, with faults injected.

    The driver's data is clean, so faults are placed by fixed arithmetic on the
    order key; every line is kept and only the listed cells are altered.
    """
    typed = order_lines(spark, sf_dir)
    key = F.col("order_id")

    def hit(m: int):
        return key % F.lit(m) == 0

    text = {c: F.col(c).cast("string") for c in ORDER_COLUMNS}
    price_text = F.col("unit_price").cast("decimal(12,2)").cast("string")
    faulted = {
        "order_id": F.when(hit(41), F.concat(F.lit("x"), text["order_id"])).otherwise(text["order_id"]),
        "user_id": F.when(hit(19), F.lit("")).otherwise(text["user_id"]),
        "product_name": F.when(hit(67), F.concat(text["product_name"], F.lit(', "quoted" name'))).otherwise(
            text["product_name"]
        ),
        "department": F.when(hit(29), F.lit(None).cast("string")).otherwise(text["department"]),
        "quantity": F.when(hit(17), F.lit("0"))
        .when(hit(43), F.lit("2.5"))
        .when(hit(71), F.concat(F.lit(" "), text["quantity"], F.lit(" ")))
        .otherwise(text["quantity"]),
        "unit_price": F.when(hit(23), F.lit("abc"))
        .when(hit(37), F.lit("-1"))
        .when(hit(59), F.lit("NaN"))
        .when(hit(61), F.lit("Infinity"))
        .when(hit(73), F.lit("1e3"))
        .when(hit(79), F.lit("5."))
        .when(hit(101), F.lit("1000000000000.5"))
        .when(hit(103), F.lit("100000000000000000.25"))
        .when(hit(107), F.lit("1e21"))
        .otherwise(price_text),
        "reordered": F.when(hit(47), F.lit("")).otherwise(text["reordered"]),
        "days_since_prior_order": F.when(hit(53) & F.col("days_since_prior_order").isNotNull(),
                                         F.concat(text["days_since_prior_order"], F.lit(".0"))).otherwise(
            text["days_since_prior_order"]
        ),
        "order_date": F.when(hit(31), F.lit("notadate"))
        .when(hit(83), F.date_format("order_date", "y-M-d"))
        .when(hit(89), F.concat(text["order_date"], F.lit("T10:00:00")))
        .otherwise(text["order_date"]),
    }
    return typed.select(*[faulted.get(c, text[c]).alias(c) for c in ORDER_COLUMNS])


# ---- normalised basket tables -------------------------------------------------------------


BASKET_TABLES = ["orders", "order_products", "products", "aisles", "departments"]


def basket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders(order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
    days_since_prior_order) with the gap as decimal text, as the file has it."""
    return customer_orders(spark, sf_dir).select(
        "order_id",
        "user_id",
        F.when(F.col("order_status") == "P", F.lit("train")).otherwise(F.lit("prior")).alias("eval_set"),
        "order_number",
        "order_dow",
        "order_hour_of_day",
        F.col("days_since_prior_order").cast("decimal(10,1)").cast("string").alias("days_since_prior_order"),
    )


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both order_products files: (order_id, product_id, reordered, split). The reorder flag is joined back left, so
    plans that never read it lose the join."""
    split = F.when(F.col("order_status") == "P", F.lit("train")).otherwise(F.lit("prior"))
    return purchases(spark, sf_dir, sequence=False).select("order_id", "product_id", "reordered", split.alias("split"))


def _dimension(spark: SparkSession, sf_dir: str, source: str, name: str, id_name: str) -> DataFrame:
    # Category names form a small closed set; dense ids follow name order.
    names = table(spark, sf_dir, "part").select(F.col(source).alias(name)).distinct()
    return names.select(F.dense_rank().over(Window.orderBy(name)).cast("int").alias(id_name), name)


def build_baskets(spark: SparkSession, sf_dir: str, only: list[str] | None = None) -> dict[str, DataFrame]:
    """The normalised tables; orders, which the calendar reads twice, are written once. ``only`` names the tables
    that are needed."""
    wanted = only or BASKET_TABLES
    out: dict[str, DataFrame] = {}
    if "orders" in wanted:
        out["orders"] = staged(basket_orders(spark, sf_dir), "orders")
    if "order_products" in wanted:
        out["order_products"] = order_products(spark, sf_dir)
    if {"products", "aisles", "departments"} & set(wanted):
        out["aisles"] = _dimension(spark, sf_dir, "p_type", "aisle", "aisle_id")
        out["departments"] = _dimension(spark, sf_dir, "p_brand", "department", "department_id")
    if "products" in wanted:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("aisle"),
            F.col("p_brand").alias("department"),
        )
        out["products"] = (
            part.join(out["aisles"], "aisle")
            .join(out["departments"], "department")
            .select("product_id", "product_name", "aisle_id", "department_id")
        )
    return out


def with_unknown_references(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with references that do not resolve, by fixed arithmetic on keys; no row is dropped."""
    products = tables["products"].withColumns(
        {
            "department_id": F.when(F.col("product_id") % 53 == 0, F.col("department_id") + 10_000).otherwise(
                F.col("department_id")
            ),
            "aisle_id": F.when(F.col("product_id") % 59 == 0, F.col("aisle_id") + 10_000).otherwise(F.col("aisle_id")),
        }
    )
    lines = tables["order_products"].withColumn(
        "product_id",
        F.when(F.col("product_id") % 61 == 0, -1 - F.col("product_id")).otherwise(F.col("product_id")),
    )
    return {**tables, "products": products, "order_products": lines}


def with_bad_gaps(orders: DataFrame) -> DataFrame:
    """Orders with day gaps that can't be, by fixed arithmetic on keys."""
    key = F.col("order_id")
    gap = (
        F.when(key % 7 == 0, F.lit("99999999"))
        .when(key % 11 == 0, F.lit("-5"))
        .when(key % 13 == 0, F.lit("soon"))
        .when(key % 17 == 0, F.lit("2000000000000"))
        .otherwise(F.col("days_since_prior_order"))
    )
    return orders.withColumn("days_since_prior_order", gap)


#: Folders that the feed of malformed rows is dealt to.
FEEDS = 8


def write_order_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw lines as CSV text, a folder per feed, with header lines, line breaks inside names and, by fixed
    arithmetic on the order key, rows that lack their last cell or have one too many."""
    lines = csv_cells(faulted_lines(spark, sf_dir))
    key = F.regexp_replace("order_id", "^x", "").try_cast("bigint")
    feed = F.pmod(F.coalesce(key, F.lit(0)), F.lit(FEEDS)).cast("int")
    cells = [F.col(f"cell_{c}") for c in ORDER_COLUMNS]
    text = (
        F.when(key % 127 == 0, F.concat_ws(",", *cells[:-1]))
        .when(key % 131 == 0, F.concat_ws(",", *cells, F.lit("more")))
        .otherwise(F.concat_ws(",", *cells))
    )
    # A task writes a file per feed, from the lines it has joined; its first line brings a header for each.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = lines.select(feed.alias("feed"), text.alias("value"), number.alias("number"))

    def row(feed, place, value):
        return F.struct(feed.alias("feed"), F.lit(place).alias("place"), value.alias("value"))

    own = row(F.col("feed"), 1, F.col("value"))
    headers = [row(F.lit(n), 0, F.lit(",".join(ORDER_COLUMNS))) for n in range(FEEDS)]
    dealt = rows.select(F.explode(F.when(F.col("number") == 0, F.array(*headers, own)).otherwise(F.array(own))).alias("row"))
    dealt = dealt.select("row.*").sortWithinPartitions("feed", "place")
    dealt.select("feed", "value").write.partitionBy("feed").text(path)


def csv_cells(lines: DataFrame) -> DataFrame:
    """Each column as CSV text (``cell_<name>``): quoted where it must be, empty for NULL; names of some orders get
    a line break."""
    key = F.regexp_replace("order_id", "^x", "").try_cast("bigint")
    name = F.when(key % 5 == 0, F.concat("product_name", F.lit("\nsecond line"))).otherwise(F.col("product_name"))

    def cell(value):
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(value.rlike('[",\n\r]'), quoted).otherwise(value), F.lit(""))

    values = {c: name if c == "product_name" else F.col(c) for c in ORDER_COLUMNS}
    return lines.select("order_id", *[cell(v).alias(f"cell_{c}") for c, v in values.items()])
