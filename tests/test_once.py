"""Texts are parsed once a row, and work is cut by the number of lines, whatever is filtered or read from it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ordermill.functions.parse import once
from ordermill.operators import baskets, validate
from ordermill.operators.marts import BASKET_MARTS, build
from ordermill.plans import registry
from ordermill.schema import ORDER_COLUMNS, ORDER_SCHEMA
from ordermill.session import folders, shared_root
from ordermill.sources import files, messages, testdata
from ordermill.streaming import ingest

SF = "/root/testdata/sf0.001"
LINE = ["1", "5", "1", "2", "9", "", "70", "Kettle", "kitchen", "home", "2", "9.35", "0", "2024-06-03"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ORDER_COLUMNS))


def test_once_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None)], "id int, t string")
    one = once(df, v=F.col("t").try_cast("int"))
    two = once(df, v=F.col("t").try_cast("int"), w=F.length("t"))
    assert sorted(map(tuple, one.collect())) == [(1, "7", 7), (2, "x", None), (3, None, None)]
    assert sorted(map(tuple, two.collect())) == [(1, "7", 7, 1), (2, "x", None, 1), (3, None, None, None)]


def test_messages_are_parsed_once(spark):
    sent = spark.createDataFrame([("1", '{"order_id":1}', "a")], messages.MESSAGE_SCHEMA)
    got = messages.decode_messages(sent, ORDER_SCHEMA).filter(~F.col("corrupt")).select(*ORDER_COLUMNS)
    assert plan(got).lower().count("from_json(") == 1
    assert got.first().order_id == 1


def test_judged_columns_are_parsed_once(spark):
    annotated = validate.annotate(raw(spark, [LINE, [*LINE[:10], "x", *LINE[11:]]]))
    refused = validate.rejected(annotated)
    assert plan(refused).count("trim(unit_price") == 1 and plan(refused).count("trim(quantity") == 1
    assert [r.reject_reason for r in refused.collect()] == ["invalid_numeric"]
    assert validate.accepted(annotated).count() == 1


def test_csv_records_are_parsed_once(spark, scratch):
    text = [",".join(ORDER_COLUMNS), ",".join(LINE), "2"]
    spark.createDataFrame([("\n".join(text),)], "value string").write.text(scratch)
    kept = validate.accepted(validate.annotate(files.read_order_rows(spark, scratch, multi_line=True)))
    assert plan(kept).lower().count("from_csv(") == 1
    assert [r.order_id for r in kept.collect()] == [1]


def test_lines_are_sent_as_columns_and_floats_as_text(spark):
    lines = raw(spark, [LINE, LINE, [None, *LINE[1:]]])
    encoded = messages.encode_messages(lines)
    above = plan(encoded).split("Aggregate")[0]
    assert "StructsToJson" in above and "StructsToJson" not in plan(encoded).split("Aggregate")[1]
    assert sorted((r.key or "", r.message_id[-2:]) for r in encoded.collect()) == [("", "-1"), ("1", "-1"), ("1", "-2")]
    prices = lines.withColumn("unit_price", F.lit(0.0)).unionByName(lines.withColumn("unit_price", F.lit(-0.0)))
    assert messages.encode_messages(prices).filter("message_id like '%-1'").count() == 4


@pytest.mark.parametrize("name", ["validate_rejected", "src_csv_orders"])
def test_raw_lines_are_not_written_first(spark, name):
    before = set(folders(spark, shared_root(spark)))
    registry.queries()[name](spark, SF)
    made = {f.rsplit("-", 1)[0] for f in set(folders(spark, shared_root(spark))) - before}
    assert "raw-lines" not in made


def test_message_files_are_packed_and_bounded(spark, scratch, monkeypatch):
    monkeypatch.setattr(ingest, "MESSAGES_A_FILE", 3)
    sent = spark.range(8).select(F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"), F.lit("m").alias("message_id"))
    ingest.write_message_files(sent.coalesce(1), scratch)
    names = [r.p for r in spark.read.text(scratch).select(F.col("_metadata.file_name").alias("p")).distinct().collect()]
    assert len(names) == 3 and all(n.endswith(".json.gz") for n in names)
    assert spark.read.schema(messages.MESSAGE_SCHEMA).json(scratch).count() == 8


def test_lines_are_joined_in_parts_of_a_bounded_number(spark, monkeypatch):
    monkeypatch.setattr(testdata, "LINES_A_TASK", 500)
    parts = testdata.line_parts(spark, SF)
    lines = testdata.table(spark, SF, "lineitem").count()
    assert parts == -(-lines // 500)
    joined = registry.all_basket_lines(spark, SF)
    assert joined.rdd.getNumPartitions() == parts
    # Two distinct counts in parts are the counts without.
    for name in ("basket_customers", "basket_category"):
        some, all_ = (build(baskets.mart_input(joined), BASKET_MARTS[name], p) for p in (parts, None))
        assert some.exceptAll(all_).isEmpty() and all_.exceptAll(some).isEmpty()


def test_strict_references_by_their_keys(spark):
    tables = testdata.build_baskets(spark, SF)
    calendar = baskets.order_calendar(tables["orders"])
    named = baskets.named_products(tables["products"], tables["aisles"], tables["departments"])
    baskets.require_references(tables["order_products"], calendar, named)
    for lacking in ((calendar, named.filter("product_id % 61 <> 0")), (calendar.withColumn("order_date", F.lit(None).cast("date")), named)):
        with pytest.raises(ValueError, match="unknown references"):
            baskets.require_references(tables["order_products"], *lacking)
