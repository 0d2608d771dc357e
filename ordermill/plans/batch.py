"""The batch jobs: order lines to revenue marts, and normalised baskets to basket marts.

Lines are written once, as Parquet partitioned by month under the shared folder
(``spark.checkpoint.dir``), and every mart reads that table: a lost executor
re-reads Parquet instead of re-running reads and joins, and each mart prunes to
its columns. What was read, kept and lost, by reason, is observed while the stage
is written; the source is read once.

Marts are built side by side in pools of their own and staged, all contracts are
checked, and only then is anything published: a fault in one mart publishes none.
The Parquet sink publishes all marts of a run with one commit, so readers see one
run's marts together. The stages are removed at the end.

usage: python -m ordermill.plans.batch --source PATH [--format csv|parquet] [--multi-line]
                                      [--sink parquet|csv|jdbc] [--out DIR] [--marts a,b]
       python -m ordermill.plans.batch --baskets FOLDER [--lenient] [--sink parquet|csv] [--out DIR]
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets
from ..operators.clean import LINE_RULES, clean_orders, exact_prices, line_counts, mart_input
from ..operators.marts import ALL_MARTS, BASKET_MARTS, REVENUE_MARTS, build, money, present
from ..session import build_session, remove_path, work_path
from ..sources import contracts, files, jdbc
from ..streaming.commits import StreamTables, Table, Version

log = logging.getLogger("ordermill.batch")

#: Takes all tables of a run, after every contract held.
Sink = Callable[[dict[str, DataFrame]], None]
#: Marts that are built at a time.
AT_ONCE = 4


def published_table(name: str, mart: DataFrame | None = None) -> Table:
    return Table(name, mart.schema if mart is not None else None, lambda rows: rows)


def parquet_sink(root: str) -> Sink:
    """One commit for all tables of a run; ``read_published`` reads those of the last one."""

    def write(tables: dict[str, DataFrame]) -> None:
        spark = next(iter(tables.values())).sparkSession
        store = StreamTables(spark, root)
        stamped = {name: contracts.stamp(table) for name, table in tables.items()}
        added = {name: store.write(published_table(name, table), table) for name, table in stamped.items()}
        last = store.live().batch
        # Only this run's tables are live: a table it does not have is no longer published.
        store.commit(last + 1, Version(last), [], added)

    return write


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the last published run."""
    store = StreamTables(spark, root)
    segments = store.live().of(name)
    if not segments:
        raise ValueError(f"{root}: no table {name} is published")
    return spark.read.parquet(*[f"{store.root}/{s}" for s in segments])


def csv_sink(root: str) -> Sink:
    """A CSV folder per table, marts in their display order: their files, by name, follow each other."""

    def write(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            files.write_csv(present(name, table) if name in ALL_MARTS else table, f"{root}/{name}")

    return write


def jdbc_sink(conn: dict[str, str] | None = None) -> Sink:
    def write(tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            jdbc.write_jdbc(table, name, conn)

    return write


def _staged_mart(lines: DataFrame, name: str, stage: str) -> tuple[DataFrame, int]:
    """A mart written below ``stage``, once its contract holds, and its rows."""
    spark = lines.sparkSession
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    log.info("building mart %s", name)
    mart = build(lines, ALL_MARTS[name])
    if name in REVENUE_MARTS:
        mart = contracts.conform(mart, name)
    rows = Observation(name)
    path = f"{stage}/{name}"
    mart.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    written = spark.read.parquet(path)
    return written, contracts.require_contract(written, name) if name in REVENUE_MARTS else rows.get["n"]


def _staged_marts(lines: DataFrame, names: list[str], stage: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """All marts, built side by side; fails if any breaks its contract."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        spark = lines.sparkSession
        one = inheritable_thread_target(spark)(_staged_mart)
        running = {name: pool.submit(one, lines, name, stage) for name in names}
    done = {name: job.result() for name, job in running.items()}
    return {name: mart for name, (mart, _) in done.items()}, {name: rows for name, (_, rows) in done.items()}


def run_batch(spark: SparkSession, lines: DataFrame, sink: Sink, marts: list[str] | None = None) -> dict[str, object]:
    """Clean ``lines`` once and publish the requested marts through ``sink``, all or none.

    Returns lines read, kept and dropped by cleaning, dropped lines by reason, revenue, and rows per mart.
    """
    stage = work_path(spark, "cleaned")
    read, kept = Observation("read"), Observation("kept")
    try:
        cleaned = mart_input(clean_orders(exact_prices(lines).observe(read, *line_counts())))
        total = money(F.sum("line_revenue")).alias("revenue")
        cleaned = cleaned.observe(kept, F.count(F.lit(1)).alias("lines"), total)
        files.write_landing(cleaned, f"{stage}/lines", only_present=False)
        staged = files.read_landing(spark, f"{stage}/lines")
        seen, clean = read.get, kept.get
        metrics = {
            "lines": seen["lines"],
            "clean_lines": clean["lines"],
            "dropped_lines": seen["lines"] - clean["lines"],
            "dropped_by_reason": {r: seen[r] for r in LINE_RULES if seen[r]},
            "clean_revenue": clean["revenue"],
        }
        log.info("cleaned lines: %s", metrics)
        built, metrics["marts"] = _staged_marts(staged, marts or list(REVENUE_MARTS), f"{stage}/marts")
        sink(built)
    finally:
        remove_path(spark, stage)
    return metrics


def stage_basket_lines(spark: SparkSession, tables: dict[str, DataFrame], path: str, strict: bool) -> dict[str, DataFrame]:
    """Resolve all basket lines once; lines, orphans, unreadable gaps and orders without lines."""
    named = baskets.named_products(tables["products"], tables["aisles"], tables["departments"])
    calendar = baskets.order_calendar(tables["orders"])
    files.by_partition(baskets.resolved_lines(tables["order_products"], calendar, named)).write.parquet(path)
    resolved = spark.read.parquet(path)
    gaps = baskets.unreadable_gaps(tables["orders"])
    if strict and not gaps.isEmpty():
        raise ValueError("orders with days_since_prior_order that is no number")
    return {
        "lines": baskets.basket_lines(resolved, strict),
        "orphan_lines": baskets.orphan_lines(resolved),
        "unreadable_gaps": gaps,
        "orders_without_lines": baskets.orders_without_lines(tables["orders"], tables["order_products"]),
    }


def basket_tables(files_by_name: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six files as five tables: both order-product files in one."""
    out = {k: v for k, v in files_by_name.items() if not k.startswith("order_products")}
    out["order_products"] = baskets.union_order_products(
        files_by_name["order_products__prior"], files_by_name["order_products__train"]
    )
    return out


def run_baskets(
    spark: SparkSession, tables: dict[str, DataFrame], sink: Sink, strict: bool = True, marts: list[str] | None = None
) -> dict[str, object]:
    """Resolve the basket lines and publish the basket marts through ``sink``, all or none.

    ``strict`` fails on unknown references and unreadable gaps; otherwise these
    lines and orders are written through ``sink`` as well, under their own names.
    """
    stage = work_path(spark, "basket-lines")
    try:
        parts = stage_basket_lines(spark, tables, f"{stage}/lines", strict)
        metrics: dict[str, object] = {name: part.count() for name, part in parts.items()}
        lines = baskets.mart_input(parts["lines"])
        built, _ = _staged_marts(lines, marts or list(BASKET_MARTS), f"{stage}/marts")
        left = {} if strict else {name: parts[name] for name in ("orphan_lines", "unreadable_gaps")}
        sink({**built, **left})
    finally:
        remove_path(spark, stage)
    log.info("baskets: %s", metrics)
    return metrics


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="order-line marts")
    parser.add_argument("--source", help="order lines")
    parser.add_argument("--baskets", help="folder with the six normalised basket files")
    parser.add_argument("--lenient", action="store_true", help="quarantine unknown references instead of failing")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quoted CSV cells")
    parser.add_argument("--sink", choices=["parquet", "csv", "jdbc"], default="parquet")
    parser.add_argument("--out", default=None, help="output folder for parquet/csv sinks")
    parser.add_argument("--marts", default=None, help="comma-separated subset")
    args = parser.parse_args(argv)
    if bool(args.source) == bool(args.baskets):
        parser.error("give either --source or --baskets")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")

    spark = build_session()
    out = args.out or work_path(spark, "marts")
    sink = {"parquet": lambda: parquet_sink(out), "csv": lambda: csv_sink(out), "jdbc": jdbc_sink}[args.sink]()
    chosen = args.marts.split(",") if args.marts else None
    if args.baskets:
        tables = basket_tables(files.read_baskets(spark, args.baskets))
        metrics = run_baskets(spark, tables, sink, not args.lenient, chosen)
    else:
        files.require_sources(spark, [args.source], args.format)
        if args.format == "csv":
            lines = files.read_order_csv(spark, args.source, args.multi_line)
        else:
            lines = spark.read.parquet(args.source)
        metrics = run_batch(spark, lines, sink, chosen)
    log.info("batch finished: %s", metrics)
    spark.stop()


if __name__ == "__main__":
    main()
