"""CSV, landing, messages, contracts, JDBC options, source checks."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from ordermill.operators.marts import REVENUE_MARTS, build
from ordermill.operators.clean import clean_orders
from ordermill.schema import ORDER_COLUMNS, ORDER_SCHEMA, RAW_SCHEMA, mart_schema
from ordermill.sources import contracts, files, jdbc, messages

from .conftest import FIXTURES

SAMPLE = os.path.join(FIXTURES, "shop_lines.csv")


def test_csv_binds_by_header_name_and_escapes(spark, scratch):
    text = files.read_order_text(spark, SAMPLE)
    odd = spark.createDataFrame(
        [tuple({"order_id": "1", "product_name": 'say "hi", ok', "quantity": "2"}.get(c) for c in ORDER_COLUMNS)],
        RAW_SCHEMA,
    )
    # Columns written in another order still land in the right place.
    files.write_csv(odd.unionByName(text).select(*reversed(ORDER_COLUMNS)), scratch)
    back = files.read_order_text(spark, scratch)
    names = {r.product_name for r in back.collect()}
    assert 'say "hi", ok' in names and 'Ink, "blue"' in names
    assert back.count() == 10


def test_csv_typed_read_nulls_bad_cells(spark, scratch):
    bad = spark.createDataFrame([("1", "abc", "2025-13-01")], "order_id string, quantity string, order_date string")
    files.write_csv(bad, scratch)
    row = files.read_order_csv(spark, scratch).first()
    assert row.order_id == 1 and row.quantity is None and row.order_date is None and row.unit_price is None


def test_landing_partitions_and_overwrites_only_present_months(spark, scratch):
    cleaned = clean_orders(files.read_order_csv(spark, SAMPLE))
    files.write_landing(cleaned, scratch)
    december = cleaned.filter(F.col("sales_month") == "2024-12-01")
    files.write_landing(december.limit(1), scratch)  # re-land one month only
    back = files.read_landing(spark, scratch)
    per_month = {r.sales_month.isoformat(): r["count"] for r in back.groupBy("sales_month").count().collect()}
    assert per_month == {"2024-11-01": 3, "2024-12-01": 1, "2025-01-01": 3}
    plan = back.filter(F.col("sales_month") == "2025-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan
    files.write_landing(december, scratch, only_present=False)
    assert files.read_landing(spark, scratch).count() == 3


def test_message_round_trip_keeps_nulls(spark):
    typed = files.read_order_csv(spark, SAMPLE)
    encoded = messages.encode_messages(typed)
    first = encoded.filter(F.col("key") == "501").first()
    assert '"days_since_prior_order":null' in first.value
    decoded = messages.decode_messages(encoded, ORDER_SCHEMA).select(*ORDER_COLUMNS)
    assert decoded.exceptAll(typed).isEmpty() and typed.exceptAll(decoded).isEmpty()


def test_corrupt_messages_are_flagged(spark):
    rows = [("1", '{"order_id": "1"}'), ("2", "not json"), ("3", None), ("4", '{"order_id": "1'), ("5", "[1]")]
    msgs = spark.createDataFrame(rows, "key string, value string")
    got = {r.key: (r.corrupt, r.value) for r in messages.decode_messages(msgs, RAW_SCHEMA).collect()}
    assert got == {k: (k != "1", v) for k, v in rows}


def test_contract_conform_and_violations(spark):
    cleaned = clean_orders(files.read_order_csv(spark, SAMPLE))
    for name, mart in REVENUE_MARTS.items():
        conformed = contracts.conform(build(cleaned, mart), name)
        assert conformed.schema.fieldNames() == mart_schema(name).fieldNames()
        v = contracts.violations(conformed, name).first()
        assert (v.null_rows, v.excess_key_rows) == (0, 0), name
        assert contracts.require_contract(conformed, name) == v.row_count
    row = (1, "a", "d", 1, 1, Decimal("10000000000.00"), Decimal("0.5"))
    dup = spark.createDataFrame([row, (1, None, *row[2:])], mart_schema("top_products").simpleString())
    v = contracts.violations(contracts.conform(dup, "top_products"), "top_products").first()
    assert (v.null_rows, v.excess_key_rows) == (1, 1)
    with pytest.raises(contracts.ContractError):
        contracts.require_contract(dup, "top_products")
    assert contracts.stamp(dup).columns[-1] == "loaded_at"


def test_table_types_are_narrow_and_overflow_fails(spark):
    rows = [(1, "a", "d", 1, 1, Decimal("10.00"), Decimal("0.5"))]
    mart = spark.createDataFrame(rows, mart_schema("top_products"))
    narrow = contracts.as_table(mart, "top_products")
    assert dict(narrow.dtypes)["order_count"] == "int" and dict(narrow.dtypes)["gross_revenue"] == "decimal(12,2)"
    assert narrow.count() == 1
    with pytest.raises(ArithmeticException):
        contracts.as_table(mart.withColumn("order_count", F.lit(2**31)), "top_products").collect()
    with pytest.raises(ArithmeticException):
        big = F.lit(Decimal("10000000000.00")).cast("decimal(38,2)")
        contracts.as_table(mart.withColumn("gross_revenue", big), "top_products").collect()


def test_jdbc_options_keep_table_definition():
    env = {"POSTGRES_HOST": "db", "POSTGRES_PORT": "5432", "POSTGRES_DB": "shop", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "pw"}
    conn = jdbc.connection(env)
    assert conn["url"] == "jdbc:postgresql://db:5432/shop" and conn["password"] == "pw"
    opts = jdbc.writer_options("monthly_sales", conn, "marts")
    assert opts["dbtable"] == "marts.monthly_sales" and opts["truncate"] == "true"
    with pytest.raises(KeyError, match="POSTGRES_DB"):
        jdbc.connection({k: v for k, v in env.items() if k != "POSTGRES_DB"})


def test_kafka_options():
    opts = messages.kafka_reader_options("broker:9092", max_offsets_per_trigger=1000)
    assert opts["includeHeaders"] == "true" and opts["subscribe"] == "ecommerce.orders" and opts["maxOffsetsPerTrigger"] == "1000"


def test_kafka_rows_carry_the_identity(spark):
    encoded = messages.encode_messages(files.read_order_text(spark, SAMPLE))
    row = messages.kafka_rows(encoded).first()
    assert row.headers[0].key == "message_id" and len(bytes(row.headers[0].value).decode().split("-")[0]) == 64


def test_path_exists_raises_other_faults(spark, scratch):
    assert not files.path_exists(spark, f"{scratch}/nothing")
    spark.range(1).write.parquet(f"{scratch}/some")
    assert files.path_exists(spark, f"{scratch}/some")
    with pytest.raises(Exception, match="nostore"):
        files.path_exists(spark, "nostore://x/y")


def test_require_sources_names_every_problem(spark, scratch):
    with pytest.raises(FileNotFoundError) as err:
        files.require_sources(spark, [SAMPLE, f"{scratch}/nope-a", f"{scratch}/nope-b"], "csv")
    assert "nope-a" in str(err.value) and "nope-b" in str(err.value) and "shop_lines" not in str(err.value)
