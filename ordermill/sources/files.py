"""File connectors: order-line CSV, named CSV outputs, Parquet landing by month."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.parse import once
from ..operators.baskets import require_unique
from ..operators.validate import typed_columns
from ..schema import BASKET_FILES, CORRUPT_ROW, ORDER_COLUMNS, RAW_SCHEMA
from .records import PLACE, SOURCE_BLOCK, SOURCE_FILE, records

# Quotes inside a quoted cell are doubled ("say ""hi"""), as spreadsheet tools write them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "inferSchema": "false", "mode": "PERMISSIVE"}

#: Different headers that the files of one read may have.
MAX_HEADERS = 100


def _text_schema(columns: list[str]) -> StructType:
    return StructType([*(StructField(c, StringType()) for c in columns), StructField(CORRUPT_ROW, StringType())])


def read_order_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Order lines as text with ``corrupt_row``, ``source_file`` and ``source_block`` (first byte of the split a row
    was read in). A row with too few or too many cells has its cells as far as they go and its whole text in
    ``corrupt_row``; validation rejects it.

    ``multi_line`` allows line breaks inside quoted cells. Files are read in splits
    either way (``records``), and files may then differ in their headers.
    """
    if multi_line:
        return _split_records(spark, path)
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    # A pruned scan would not count the cells of a row.
    whole = {"columnNameOfCorruptRecord": CORRUPT_ROW, "columnPruning": "false"}
    reader = spark.read.options(**CSV_OPTIONS, **whole)
    # A header cell that names the capture column itself would be taken for it.
    if CORRUPT_ROW in header:
        raise ValueError(f"{path}: a column is named {CORRUPT_ROW}")
    rows = reader.schema(_text_schema(header)).csv(path)
    source = [F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias(SOURCE_BLOCK)]
    return rows.select(
        *[(F.col(c) if c in header else F.lit(None).cast("string")).alias(c) for c in ORDER_COLUMNS],
        CORRUPT_ROW,
        *source,
    )


def _split_records(spark: SparkSession, path: str) -> DataFrame:
    found = records(spark, path)
    # The first record of a file is its header: one short row per file, few different ones.
    first = found.filter("top").select(SOURCE_FILE, F.col("record").alias("header"))
    headers = [r.header for r in first.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    rows = found.filter(~F.col("top") & (F.col("record") != ""))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"columnNameOfCorruptRecord": CORRUPT_ROW}
    parsed = None
    for header in headers:
        columns = next(csv.reader([header]))
        ddl = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT_ROW])
        cells = F.from_csv("record", ddl, {**options, "multiLine": "true"})
        own = rows if len(headers) == 1 else rows.join(first.filter(F.col("header") == header), SOURCE_FILE, "left_semi")
        own = once(own, cells=F.when(~F.col("open"), cells))
        part = own.select(
            *[(F.col(f"cells.`{c}`") if c in columns else F.lit(None).cast("string")).alias(c) for c in ORDER_COLUMNS],
            F.when(F.col("open"), F.col("record")).otherwise(F.col(f"cells.{CORRUPT_ROW}")).alias(CORRUPT_ROW),
            SOURCE_FILE,
            SOURCE_BLOCK,
        )
        parsed = part if parsed is None else parsed.unionByName(part)
    if parsed is None:
        schema = StructType([*RAW_SCHEMA.fields, *_text_schema([]).fields]).add(SOURCE_FILE, StringType())
        return spark.createDataFrame([], schema.add(SOURCE_BLOCK, LongType()))
    return parsed


def read_order_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Order lines as text, columns bound by header name; absent columns are NULL. Rows of the wrong number of cells
    come as far as they go: ``read_order_rows`` names them."""
    return read_order_rows(spark, path, multi_line).select(*ORDER_COLUMNS)


def read_order_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Typed order lines of the whole rows; a cell that does not parse becomes NULL (cleaning drops and counts the
    line), and so do all cells of a row that is no whole row."""
    rows = read_order_rows(spark, path, multi_line)
    typed = typed_columns()
    whole = F.col(CORRUPT_ROW).isNull()
    return rows.select(*[F.when(whole, typed[c]).alias(c) for c in ORDER_COLUMNS])


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """Named CSV output with a header and a fixed column order, replacing earlier output; a file per task."""
    df.select(*(fields or df.columns)).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a CSV written by ``write_csv`` back into typed columns by header name."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one value of the partition columns together, so that few files are written; adaptive execution
    splits values with much data and joins values with little."""
    return df.hint("rebalance", *columns)


def write_landing(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = ("sales_month",), only_present: bool = True
) -> None:
    """Parquet partitioned by month. With ``only_present`` only the months in ``df`` are replaced, so a re-run of
    one day's data is idempotent; otherwise the whole table is."""
    (
        by_partition(df, *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_present else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing table; filters on ``sales_month`` prune whole partitions."""
    return spark.read.parquet(path).withColumn("sales_month", F.col("sales_month").cast("date"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists; any other fault of the store is raised."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_basket_file(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One normalised basket CSV (``root/name.csv``), columns bound by header name, in the file's types; a cell
    that does not parse is NULL, a column the file lacks is an error."""
    schema = BASKET_FILES[name]
    raw = spark.read.options(**CSV_OPTIONS).csv(f"{root}/{name}.csv")
    absent = [f.name for f in schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{name}: no column " + ", ".join(absent))
    return raw.select(*[F.trim(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_baskets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All six basket files, present and not empty, dimensions with unique keys."""
    require_sources(spark, [f"{root}/{name}.csv" for name in BASKET_FILES], "csv")
    tables = {name: read_basket_file(spark, root, name) for name in BASKET_FILES}
    for name, key in (("products", "product_id"), ("aisles", "aisle_id"), ("departments", "department_id")):
        require_unique(tables[name], key)
    return tables


def require_sources(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> None:
    """Fail once, naming every source that is missing or holds no rows."""
    problems = []
    for path in paths:
        try:
            reader = spark.read.format(fmt)
            if fmt == "csv":
                reader = reader.options(**CSV_OPTIONS)
            if reader.load(path).isEmpty():
                problems.append(f"{path} (empty)")
        except AnalysisException:
            problems.append(f"{path} (missing)")
    if problems:
        raise FileNotFoundError("sources not usable: " + ", ".join(problems))
