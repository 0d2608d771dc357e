"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType

from ..operators import baskets, validate
from ..operators.clean import clean_orders, mart_input
from ..operators.marts import BASKET_MARTS, REVENUE_MARTS, Mart, build, distinct_measures, orders_of
from ..schema import ORDER_COLUMNS, ORDER_SCHEMA, RAW_SCHEMA, mart_schema
from ..session import CODEC, delete_below, remove_path, short_shuffles, work_path
from ..sources import contracts, files, messages, records, testdata
from ..streaming import calendar, ingest
from ..streaming.commits import FANOUT, StreamTables
from .batch import basket_tables

Query = Callable[[SparkSession, str], DataFrame]


def as_result(df: DataFrame) -> DataFrame:
    """Edge conversion for comparison: exact decimals leave as text, so that every digit counts."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(testdata.order_lines(spark, sf_dir))


def mart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines projected to the mart input; the marts never read the
    per-customer sequence columns, so the adapter does not build them."""
    return mart_input(clean_orders(testdata.order_lines(spark, sf_dir, sequence=False)))


def _read_once(lines: DataFrame, mart: Mart) -> DataFrame:
    """Lines written once for a mart that ``build`` aggregates twice, so that no source is joined and read twice."""
    return testdata.staged(lines, "mart-lines") if len(distinct_measures(mart)) > 2 else lines


def q_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_result(cleaned_lines(spark, sf_dir))


def _mart_query(mart: Mart) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_result(build(_read_once(mart_lines(spark, sf_dir), mart), mart))

    return run


# ---- validation ----------------------------------------------------------------------------


def annotated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.annotate(testdata.faulted_lines(spark, sf_dir))


def q_validate_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_result(validate.accepted(annotated_lines(spark, sf_dir)))


def q_validate_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejected(annotated_lines(spark, sf_dir))


def q_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reject_summary(validate.rejected(annotated_lines(spark, sf_dir)))


def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.ingest_counts(annotated_lines(spark, sf_dir))


VALIDATION_QUERIES: dict[str, Query] = {
    "validate_accepted": q_validate_accepted,
    "validate_rejected": q_validate_rejected,
    "reject_summary": q_reject_summary,
    "ingest_counts": q_ingest_counts,
}


# ---- normalised baskets --------------------------------------------------------------------


def resolved(spark: SparkSession, tables: dict[str, DataFrame], parts: int, strict: bool = False) -> DataFrame:
    named = baskets.named_products(tables["products"], tables["aisles"], tables["departments"])
    calendar = baskets.order_calendar(tables["orders"])
    if strict:
        calendar = testdata.staged(calendar, "calendar")
        baskets.require_references(tables["order_products"], calendar, named)
    return baskets.resolved_lines(tables["order_products"], calendar, named, parts)


def all_basket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testdata.build_baskets(spark, sf_dir)
    return baskets.basket_lines(resolved(spark, tables, testdata.line_parts(spark, sf_dir)))


def q_basket_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.build_baskets(spark, sf_dir, ["order_products"])["order_products"]


def q_order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.order_calendar(testdata.build_baskets(spark, sf_dir, ["orders"])["orders"])


def q_unreadable_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.unreadable_gaps(testdata.with_bad_gaps(testdata.build_baskets(spark, sf_dir, ["orders"])["orders"]))


def q_calendar_with_bad_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.order_calendar(testdata.with_bad_gaps(testdata.build_baskets(spark, sf_dir, ["orders"])["orders"]))


def q_calendar_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar after three increments: orders in the order of their numbers, every seventh one late."""
    orders = testdata.build_baskets(spark, sf_dir, ["orders"])["orders"]
    part = F.when(F.col("order_id") % 7 == 0, 2).when(F.col("order_number") <= 4, 0).when(F.col("order_number") <= 8, 1).otherwise(2)
    store = StreamTables(spark, work_path(spark, "calendar"))
    for number in range(3):
        calendar.add_orders(store, orders.filter(part == number), number)
    return calendar.read_calendar(spark, store.root)


def q_orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = testdata.build_baskets(spark, sf_dir, ["orders", "order_products"])
    return baskets.orders_without_lines(tables["orders"], tables["order_products"])


def q_orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown products, departments and aisles, put in by arithmetic on keys."""
    tables = testdata.with_unknown_references(testdata.build_baskets(spark, sf_dir))
    return baskets.orphan_lines(resolved(spark, tables, testdata.line_parts(spark, sf_dir)))


def q_resolved_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the lines in lenient mode."""
    tables = testdata.with_unknown_references(testdata.build_baskets(spark, sf_dir))
    return baskets.basket_lines(resolved(spark, tables, testdata.line_parts(spark, sf_dir)))


def q_basket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised tables written as the six CSV files, read back with key checks, and resolved strictly."""
    root = work_path(spark, "basket-files")
    tables = testdata.build_baskets(spark, sf_dir)
    lines = tables.pop("order_products").withColumn("add_to_cart_order", F.lit(1))
    for split in ("prior", "train"):
        columns = ["order_id", "product_id", "add_to_cart_order", "reordered"]
        files.write_csv(lines.filter(F.col("split") == split), f"{root}/order_products__{split}.csv", columns)
    for name, df in tables.items():
        files.write_csv(df, f"{root}/{name}.csv")
    back = basket_tables(files.read_baskets(spark, root))
    return baskets.basket_lines(resolved(spark, back, testdata.line_parts(spark, sf_dir), strict=True))


def _basket_query(mart: Mart) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = _read_once(baskets.mart_input(all_basket_lines(spark, sf_dir)), mart)
        return as_result(build(lines, mart, testdata.line_parts(spark, sf_dir)))

    return run


BASKET_QUERIES: dict[str, Query] = {
    "dim_products": lambda spark, d: baskets.require_unique(
        testdata.build_baskets(spark, d, ["products"])["products"], "product_id"
    ),
    "basket_union": q_basket_union,
    "order_calendar": q_order_calendar,
    "calendar_increments": q_calendar_increments,
    "unreadable_gaps": q_unreadable_gaps,
    "calendar_with_bad_gaps": q_calendar_with_bad_gaps,
    "basket_lines": all_basket_lines,
    "orphan_lines": q_orphan_lines,
    "resolved_lines": q_resolved_lines,
    "basket_files": q_basket_files,
    "orders_without_lines": q_orders_without_lines,
    **{name: _basket_query(mart) for name, mart in BASKET_MARTS.items()},
}


# ---- connectors, contracts, streaming ------------------------------------------------------


def q_src_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "orders-csv")
    files.write_csv(testdata.faulted_lines(spark, sf_dir), path, list(ORDER_COLUMNS))
    return as_result(files.read_order_csv(spark, path))


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a CSV feed with line breaks in cells and malformed rows, annotated; ``source`` is the folder."""
    path = work_path(spark, "order-feed")
    with short_shuffles(spark):
        testdata.write_order_feed(spark, sf_dir, path)
    rows = validate.annotate(files.read_order_rows(spark, path, multi_line=True))
    # Its records are written, and nothing reads the feed again.
    remove_path(spark, path)
    return rows.withColumn("source", F.regexp_extract(records.SOURCE_FILE, "/(feed=[0-9]+)/", 1))


def q_csv_rejects_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reject_summary(validate.rejected(feed_rows(spark, sf_dir)), ("source",))


def q_csv_accepted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_result(validate.accepted(feed_rows(spark, sf_dir)).select(*ORDER_COLUMNS))


def q_sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "top-products-csv")
    mart = contracts.conform(build(mart_lines(spark, sf_dir), REVENUE_MARTS["top_products"]), "top_products")
    files.write_csv(mart, path)
    return as_result(files.read_csv_table(spark, path, mart_schema("top_products")))


def accepted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.accepted(annotated_lines(spark, sf_dir))


def q_encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, the value's own text, and identity of every accepted line's message."""
    return messages.encode_messages(accepted_lines(spark, sf_dir).select(*ORDER_COLUMNS))


def q_decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = messages.encode_messages(accepted_lines(spark, sf_dir))
    decoded = messages.decode_messages(encoded, ORDER_SCHEMA).filter(~F.col("corrupt"))
    return as_result(decoded.select(*ORDER_COLUMNS))


def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract checks of the revenue marts over lines with faults: products with no name (a NULL in the mart) and
    with a second department (a key used twice)."""
    product = F.col("product_id")
    lines = testdata.staged(
        mart_lines(spark, sf_dir)
        .withColumn("product_name", F.when(product % 97 != 0, F.col("product_name")))
        .withColumn(
            "department",
            F.when((product % 89 == 0) & (F.col("order_id") % 2 == 0), F.concat("department", F.lit(" II"))).otherwise(
                F.col("department")
            ),
        ),
        "mart-lines",
    )
    checks = [
        contracts.violations(contracts.conform(build(lines, mart), name), name) for name, mart in REVENUE_MARTS.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def q_landing_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "landing")
    files.write_landing(cleaned_lines(spark, sf_dir), path)
    return as_result(files.read_landing(spark, path))


#: Lines of a feed that are published at once, as far as its parts stay fewer than FANOUT: with as many segments the
#: stream's tables are written a second time.
LINES_A_PART = 1_000_000


def _feed_parts(spark: SparkSession, sf_dir: str) -> int:
    return min(-(-testdata.line_parts(spark, sf_dir) * testdata.LINES_A_TASK // LINES_A_PART), FANOUT - 1)


def _feed(lines: DataFrame) -> DataFrame:
    """Lines as messages. Some messages are cut off, some have text after the object, some hold two objects: all three
    are corrupt and kept as text in quarantine."""
    order, value = F.col("key").try_cast("bigint"), F.col("value")
    damaged = (
        F.when(order % 107 == 0, F.substring("value", 1, 20))
        .when(order % 109 == 0, F.concat(value, F.lit(" trailing")))
        .when(order % 113 == 0, F.concat(value, value))
        .otherwise(value)
    )
    return messages.encode_messages(lines).withColumn("value", damaged).select("key", "value", "message_id")


def _run_stream(
    spark: SparkSession,
    sf_dir: str,
    replays: int = 1,
    dedup: bool = False,
    marts: tuple[str, ...] = (),
    batches: int | None = None,
) -> str:
    """Folder of a stream's tables, fed with the raw lines as messages: published in ``batches`` parts (as the lines'
    number has it, if not given), which come as micro-batches, and all of it ``replays`` times.

    What waits to be published are the lines, a fifth of their messages in size. A part is drained before the next
    comes: it is a batch of its own in however many files it comes, and a replay meets what the batches before have
    landed. Then its message files are removed, and after the last replay its lines."""
    root = work_path(spark, "stream")
    inbox, waiting = f"{root}/inbox", f"{root}/lines"
    targets = ingest.IngestTargets(f"{root}/tables", marts, dedup)
    batches = batches or _feed_parts(spark, sf_dir)
    with short_shuffles(spark):
        # Equal lines come in one part, so their messages are numbered as in the whole feed.
        part = F.pmod(F.xxhash64(*ORDER_COLUMNS), F.lit(batches)).cast("int")
        lines = testdata.faulted_lines(spark, sf_dir).withColumn("part", part)
        lines.write.option("compression", CODEC).partitionBy("part").parquet(waiting)
        feed = spark.read.schema(StructType([*RAW_SCHEMA.fields, StructField("part", IntegerType())])).parquet(waiting)
        for replay in range(replays):
            for number in range(batches):
                ingest.write_message_files(_feed(feed.filter(F.col("part") == number).drop("part")), inbox)
                if replay == replays - 1:
                    delete_below(spark, root, f"{waiting}/part={number}")
                query = ingest.start_ingest(ingest.message_file_stream(spark, inbox), targets, checkpoint=f"{root}/checkpoint")
                query.awaitTermination()
                if query.exception():
                    raise query.exception()
                delete_below(spark, root, inbox)
    return targets.root


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_result(ingest.read_landed(spark, _run_stream(spark, sf_dir)))


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = ingest.read_quarantine(spark, _run_stream(spark, sf_dir, replays=2, dedup=True))
    corrupt = F.col(validate.REASON) == ingest.CORRUPT
    return refused.select(
        *ORDER_COLUMNS, validate.REASON, "message_key", F.when(corrupt, F.col("message_value")).alias("corrupt_text")
    )


def q_stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read, repeated, accepted and rejected over all batches of a feed published in two parts."""
    counted = ingest.read_batches(spark, _run_stream(spark, sf_dir, batches=2))
    return counted.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ingest.COUNTS])


def _stream_mart_query(name: str) -> Query:
    """A revenue mart kept up to date over three batches."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_result(ingest.read_mart(spark, _run_stream(spark, sf_dir, marts=(name,), batches=3), name))

    return run


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_result(ingest.read_landed(spark, _run_stream(spark, sf_dir, replays=2, dedup=True)))


CONNECTOR_QUERIES: dict[str, Query] = {
    "src_csv_orders": q_src_csv_orders,
    "csv_rejects_by_source": q_csv_rejects_by_source,
    "csv_accepted_lines": q_csv_accepted_lines,
    "sink_csv_roundtrip": q_sink_csv_roundtrip,
    "encode_messages": q_encode_messages,
    "decode_messages": q_decode_messages,
    "contract_violations": q_contract_violations,
    "landing_by_month": q_landing_by_month,
    "stream_ingest": q_stream_ingest,
    "stream_quarantine": q_stream_quarantine,
    "stream_batch_counts": q_stream_batch_counts,
    **{f"stream_{name}": _stream_mart_query(name) for name in REVENUE_MARTS},
    "stream_dedup": q_stream_dedup,
}


def queries() -> dict[str, Query]:
    registry: dict[str, Query] = {
        "clean_orders": q_clean_orders,
        "order_summary": lambda spark, d: as_result(orders_of(mart_lines(spark, d))),
    }
    for name, mart in REVENUE_MARTS.items():
        registry[name] = _mart_query(mart)
    registry.update(VALIDATION_QUERIES)
    registry.update(BASKET_QUERIES)
    registry.update(CONNECTOR_QUERIES)
    return registry
