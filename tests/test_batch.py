"""The batch job: whole stages, contracts before writing, sorted output, counts of lost lines."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans import batch
from ordermill.session import remove_path, shared_root
from ordermill.sources import contracts, files

from .conftest import FIXTURES


@pytest.fixture
def shop(spark):
    return files.read_order_csv(spark, os.path.join(FIXTURES, "shop_lines.csv"))


def test_a_second_run_has_only_its_own_months(spark, shop, scratch):
    out = f"{scratch}/out"
    sink = batch.parquet_sink(out)
    assert batch.run_batch(spark, shop, sink)["clean_lines"] == 9
    later = shop.filter(F.col("order_date") >= "2025-01-01")
    metrics = batch.run_batch(spark, later, sink)
    assert metrics["lines"] == metrics["clean_lines"] == 3
    months = [str(r.sales_month) for r in batch.read_published(spark, out, "monthly_sales").collect()]
    assert months == ["2025-01-01"]
    batch.run_batch(spark, shop, sink, ["top_products"])
    with pytest.raises(ValueError):
        batch.read_published(spark, out, "monthly_sales")
    assert batch.read_published(spark, out, "top_products").count() == 5
    # Stages are removed.
    left = [p for p in os.listdir(shared_root(spark).removeprefix("file:")) if p.startswith("cleaned-")]
    assert left == []


def test_lines_lost_in_cleaning_are_counted(spark, shop):
    broken = shop.withColumn("unit_price", F.when(F.col("order_id") != 503, F.col("unit_price")))
    broken = broken.withColumn("quantity", F.when(F.col("order_id") == 504, F.lit(0)).otherwise(F.col("quantity")))
    metrics = batch.run_batch(spark, broken, lambda tables: None, ["monthly_sales"])
    lost = shop.filter("order_id = 504").count()
    assert (metrics["lines"], metrics["clean_lines"], metrics["dropped_lines"]) == (9, 8 - lost, 1 + lost)
    assert metrics["dropped_by_reason"] == {"no_unit_price": 1, "quantity_not_positive": lost}
    assert list(metrics["marts"]) == ["monthly_sales"]


def test_nothing_is_published_when_one_mart_breaks_its_contract(spark, shop, scratch):
    double = shop.withColumn(
        "department", F.when(F.col("order_id") == 503, F.lit("garden")).otherwise(F.col("department"))
    )
    out = f"{scratch}/out"
    batch.run_batch(spark, shop, batch.parquet_sink(out))
    before = sorted(map(str, batch.read_published(spark, out, "monthly_sales").collect()))
    with pytest.raises(contracts.ContractError, match="top_products: 0 rows with a NULL, 1 rows with a key"):
        batch.run_batch(spark, double, batch.parquet_sink(out), ["monthly_sales", "top_products"])
    assert sorted(map(str, batch.read_published(spark, out, "monthly_sales").collect())) == before
    written = []
    with pytest.raises(contracts.ContractError):
        batch.run_batch(spark, double, written.append, ["monthly_sales", "top_products"])
    assert written == []


def test_the_source_is_read_once(spark, shop, scratch):
    """Rows that leave the source are counted as they are read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for rows in batches:
            seen.add(rows.num_rows)
            yield rows

    metrics = batch.run_batch(spark, shop.mapInArrow(count, shop.schema), lambda tables: None)
    assert metrics["lines"] == seen.value == 9 and len(metrics["marts"]) == 5


def test_csv_files_are_in_mart_order(spark, shop, scratch):
    batch.run_batch(spark, shop.repartition(5), batch.csv_sink(scratch), ["top_products", "customer_metrics"])
    for name, column, want in (("top_products", "product_id", [901, 903, 902, 900, 904]), ("customer_metrics", "user_id", [12, 13, 11, 14])):
        folder = f"{scratch.removeprefix('file:')}/{name}"
        rows = []
        for part in sorted(p for p in os.listdir(folder) if p.endswith(".csv")):
            path = f"file:{folder}/{part}"
            rows += [int(r[column]) for r in spark.read.option("header", True).csv(path).collect()]
        assert rows == want


def test_only_work_folders_are_removed(spark):
    with pytest.raises(ValueError):
        remove_path(spark, "/tmp/else")
