"""CSV rows: records with line breaks cut over many splits, malformed rows reported with their file and split."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import validate
from ordermill.plans import registry
from ordermill.schema import CORRUPT_ROW, ORDER_COLUMNS
from ordermill.session import folders, shared_root
from ordermill.sources import files, records, testdata


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def write(spark, path, text):
    """A file as it is, through Hadoop: the folder is the shared one."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(text.encode()))
    out.close()


def sample(n, end="\n"):
    rnd = random.Random(4)
    names = ["plain", 'say "hi", ok', "two\nlines", "a\n\nb\n", '"\n"', "x" * 90, "ends with cr\r\nhere", ""]
    rows = [
        [str(i), str(i % 7), "1", "2", "9", "", str(i % 5), rnd.choice(names), "aisle", "dep", "2", "1.50", "0", "2024-06-03"]
        for i in range(n)
    ]
    cell = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') else c
    return rows, end.join(",".join(map(cell, r)) for r in [ORDER_COLUMNS, *rows]) + end


def test_cells_with_line_breaks_in_many_splits(spark, scratch, small_splits):
    rows, text = sample(900)
    write(spark, f"{scratch}/a.csv", text)
    got = files.read_order_rows(spark, f"{scratch}/a.csv", multi_line=True)
    assert got.select(records.SOURCE_BLOCK).distinct().count() >= 8
    want = [tuple(c or None for c in r) for r in rows]
    assert sorted(str(tuple(r)[:14]) for r in got.collect()) == sorted(map(str, want))
    assert got.filter(F.col(CORRUPT_ROW).isNotNull()).isEmpty()
    whole = spark.read.options(**files.CSV_OPTIONS).option("multiLine", "true").csv(f"{scratch}/a.csv")
    whole = whole.withColumn("product_name", F.replace("product_name", F.lit("\r\n"), F.lit("\n")))
    same = got.select(*ORDER_COLUMNS).withColumn("product_name", F.replace("product_name", F.lit("\r\n"), F.lit("\n")))
    assert same.exceptAll(whole).isEmpty() and whole.exceptAll(same).isEmpty()


def test_windows_line_ends_and_files_with_other_headers(spark, scratch, small_splits):
    rows, text = sample(60, "\r\n")
    write(spark, f"{scratch}/a.csv", text)
    write(spark, f"{scratch}/b.csv", 'quantity,order_id,"extra ""col"""\n3,700,z\n\n4,701,"q\nq"\n')
    got = files.read_order_rows(spark, scratch, multi_line=True)
    assert got.filter(F.col(CORRUPT_ROW).isNotNull()).isEmpty() and got.count() == 62
    by_id = {r.order_id: r for r in got.collect()}
    assert by_id["701"].quantity == "4" and by_id["701"].user_id is None and by_id["59"].order_date == "2024-06-03"
    assert by_id["700"].source_file.endswith("/b.csv")


def test_record_longer_than_a_split(spark, scratch, small_splits):
    name = "\n".join("line %d" % i for i in range(900))
    write(spark, f"{scratch}/a.csv", f'order_id,product_name\n1,"{name}"\n2,b\n')
    got = {r.order_id: r.product_name for r in files.read_order_rows(spark, scratch, multi_line=True).collect()}
    assert got == {"1": name, "2": "b"}


def test_a_quote_that_is_never_closed_loses_no_line(spark, scratch, small_splits, monkeypatch):
    monkeypatch.setattr(records.records, "__defaults__", (500,))
    lines = [f"{i},name {i}" for i in range(300)]
    lines[40] = '40,"open'
    write(spark, f"{scratch}/a.csv", "order_id,product_name\n" + "\n".join(lines) + "\n")
    got = files.read_order_rows(spark, scratch, multi_line=True)
    bad = got.filter(F.col(CORRUPT_ROW).isNotNull())
    assert sorted(r[CORRUPT_ROW] for r in bad.collect()) == sorted(lines[40:])
    assert got.filter(F.col(CORRUPT_ROW).isNull()).count() == 40


@pytest.mark.parametrize("multi_line", [False, True])
def test_short_and_long_rows_are_rejected_with_their_source(spark, scratch, multi_line):
    good = "1,5,1,2,9,,70,Kettle,kitchen,home,2,9.35,0,2024-06-03"
    rows = {"a": [good, good + ",more", good.rsplit(",", 1)[0]], "b": [good, "2"], "c": []}
    for name, lines in rows.items():
        write(spark, f"{scratch}/{name}.csv", "\n".join([",".join(ORDER_COLUMNS), *lines]) + "\n")
    annotated = validate.annotate(files.read_order_rows(spark, scratch, multi_line))
    assert validate.accepted(annotated).count() == 2
    refused = validate.rejected(annotated).collect()
    found = sorted((r.source_file.rsplit("/", 1)[1], r.source_block, r[CORRUPT_ROW]) for r in refused)
    assert found == [("a.csv", 0, rows["a"][2]), ("a.csv", 0, rows["a"][1]), ("b.csv", 0, "2")]
    assert {r[validate.REASON] for r in refused} == {validate.MALFORMED}
    by_file = validate.reject_summary(validate.rejected(annotated), (records.SOURCE_FILE,)).collect()
    assert sorted(r.rejected_lines for r in by_file) == [1, 2]
    # Typed reads drop nothing: such a row has no cells, and cleaning counts it.
    typed = files.read_order_csv(spark, scratch, multi_line)
    assert typed.count() == 5 and typed.filter("order_id is null").count() == 3


def test_empty_files(spark, scratch):
    write(spark, f"{scratch}/a.csv", ",".join(ORDER_COLUMNS) + "\n")
    assert files.read_order_rows(spark, scratch, multi_line=True).count() == 0
    write(spark, f"{scratch}-b/a.csv", "")
    assert files.read_order_rows(spark, f"{scratch}-b", multi_line=True).count() == 0


def test_lines_are_shuffled_in_parts_of_the_files(spark, scratch, small_splits, monkeypatch):
    """Records that go over splits, in parts of the files and in all of them; the files are not read again."""
    for n in range(5):
        write(spark, f"{scratch}/f{n}.csv", sample(100 + n)[1])
    get = lambda: sorted(str(tuple(r)[:14]) for r in files.read_order_rows(spark, scratch, multi_line=True).collect())
    whole = get()
    assert len(whole) == 510
    monkeypatch.setattr(records, "PART_BYTES", 9_000)
    assert records._parts(spark, scratch) > 2
    got = records.physical_lines(spark, scratch, 0, 3)
    assert got.select(records.SOURCE_FILE).distinct().count() < 5
    assert get() == whole
    rows = files.read_order_rows(spark, scratch, multi_line=True)
    spark._jvm.org.apache.hadoop.fs.Path(scratch).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(scratch), True
    )
    assert rows.count() == 510


def test_a_feed_is_written_without_a_shuffle_of_its_text_and_removed_when_read(spark, scratch):
    """A header for every file, whichever task wrote it; the lines of one order in five have names of two lines."""
    orders = "id o_orderkey, 1L + id % 2 o_custkey, 'O' o_orderstatus, timestamp'2025-01-05 10:00:00' o_orderdate"
    tables = {
        "part": spark.range(1, 4).selectExpr("id p_partkey", "'p' p_name", "'a' p_type", "'d' p_brand", "2.5D p_retailprice"),
        "orders": spark.range(50).selectExpr(*orders.split(", ")),
        "lineitem": spark.range(100).selectExpr("id div 2 l_orderkey", "1 + id % 3 l_partkey", "3.0D l_quantity"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{scratch}/{name}.parquet")
    testdata.write_order_feed(spark, scratch, f"{scratch}/feed")
    text = spark.read.text(f"{scratch}/feed").select("value", F.col("_metadata.file_path").alias("f"))
    headers = text.filter(F.col("value") == ",".join(ORDER_COLUMNS)).groupBy("f").count().collect()
    assert {r["count"] for r in headers} == {1} and len(headers) == text.select("f").distinct().count()
    assert set(folders(spark, f"{scratch}/feed")) == {f"feed={n}" for n in range(testdata.FEEDS)}
    before = set(folders(spark, shared_root(spark)))
    rows = registry.feed_rows(spark, scratch)
    made = {f.rsplit("-", 1)[0] for f in set(folders(spark, shared_root(spark))) - before}
    assert "order-feed" not in made
    assert rows.count() == 100 and rows.select("source").distinct().count() == testdata.FEEDS
    assert rows.filter(F.col("product_name").endswith("\nsecond line")).count() == 20
