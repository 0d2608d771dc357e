"""CSV records with line breaks inside quoted cells, from files that many tasks read at once.

A task that starts in the middle of a file can't tell whether it starts inside a
quoted cell. It can count quotes, though: a line starts inside a cell when the
quotes before it in its file are odd in number (a quote inside a cell is written
twice, so it doesn't matter). So:

1. the file is read as physical lines, in splits; quotes are counted along each split, and the last line that starts a
   record is noted for both cases, a split that begins outside a cell and one that begins inside. This is written once,
   some files after another (``PART_BYTES``), so that only a part's lines lie in shuffle files at a time;
2. quotes are summed along the splits of a file, one row per split (a prefix sum in two levels, as in
   ``operators.running``), which says of each split how it begins;
3. a line that doesn't start inside a cell starts a record; the others belong to
   the last start before them, be it in an earlier split;
4. lines of records of several lines are brought together and joined, and written once; all other
   lines are records as they are and go nowhere.

A quote that is never closed would swallow the rest of its file. A record of more
than ``MAX_RECORD_BYTES`` is taken for that: its lines come back one by one, marked
as open, and none is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import CODEC, short_shuffles, staged, work_path

#: Bytes above which a quoted record counts as one that was never closed.
MAX_RECORD_BYTES = 1 << 20
#: Name, start of the split and place of a record.
SOURCE_FILE, SOURCE_BLOCK, PLACE = "source_file", "source_block", "source_place"
#: Bytes of files whose lines are shuffled at a time, and the most such parts.
PART_BYTES, MOST_PARTS = 1 << 30, 64


def physical_lines(spark: SparkSession, path: str, part: int = 0, parts: int = 1) -> DataFrame:
    """source_file, source_block (first byte of the split), source_place (grows along a split), line; of several
    ``parts`` of the files only one."""
    lines = spark.read.option("lineSep", "\n").text(path)
    if parts > 1:
        # A condition on the file's name: other files are not opened.
        lines = lines.filter(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(parts)) == part)
    return lines.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        F.monotonically_increasing_id().alias(PLACE),
        F.col("value").alias("line"),
    )


def _parts(spark: SparkSession, path: str) -> int:
    size = int(str(spark.read.text(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(1, -(-size // PART_BYTES)), MOST_PARTS)


def _along_splits(lines: DataFrame) -> DataFrame:
    """Adds, as if each split began outside a cell: ``inside`` and ``inside_after`` of a line, and the place of the last
    start up to it (``start``); ``other_start`` is that of a split which begins inside. ``top`` marks a file's first
    line."""
    block = [SOURCE_FILE, SOURCE_BLOCK]
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    ordered = Window.partitionBy(*block).orderBy(PLACE)
    before = F.sum(quotes).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    counted = lines.select("*", quotes.alias("quotes"), before.alias("before"))
    sure = F.coalesce("before", F.lit(0))
    marked = counted.select(
        *block, PLACE, "line", (sure % 2 == 1).alias("inside"), ((sure + F.col("quotes")) % 2 == 1).alias("inside_after"),
        (F.col("before").isNull() & (F.col(SOURCE_BLOCK) == 0)).alias("top"),
    )
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.select(
        "*",
        F.max(F.when(~F.col("inside"), F.col(PLACE))).over(upto).alias("start"),
        F.max(F.when(F.col("inside"), F.col(PLACE))).over(upto).alias("other_start"),
    )


def _with_starts(spark: SparkSession, path: str) -> DataFrame:
    """The files' lines with ``first``, the block and place of the line that starts the record, whether that is the line
    itself (``own``) and whether a cell is open after it (``open_after``)."""
    folder, parts = work_path(spark, "csv-lines"), _parts(spark, path)
    for part in range(parts):
        marked = _along_splits(physical_lines(spark, path, part, parts))
        marked.write.mode("append").option("compression", CODEC).parquet(folder)
    lines = spark.read.schema(marked.schema).parquet(folder)
    block = [SOURCE_FILE, SOURCE_BLOCK]
    splits = lines.groupBy(*block).agg(
        F.count_if(F.col("inside") != F.col("inside_after")).alias("odd"), F.max("start").alias("a"), F.max("other_start").alias("b")
    )
    before = Window.partitionBy(SOURCE_FILE).orderBy(SOURCE_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("begins_inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    # A split may begin inside a record of an earlier one: the last start before it.
    last = F.when(F.col("begins_inside"), F.col("b")).otherwise(F.col("a"))
    last = F.when(last.isNotNull(), F.struct(F.col(SOURCE_BLOCK).alias("block"), last.alias("place")))
    splits = splits.withColumn("last", last).select(
        *block, "begins_inside", F.last("last", ignorenulls=True).over(before).alias("earlier")
    )
    # One row per split: the lines stay where they are.
    placed = lines.join(F.broadcast(splits), block)
    begins = F.col("begins_inside")
    start = F.when(begins, F.col("other_start")).otherwise(F.col("start"))
    start = F.when(start.isNotNull(), F.struct(F.col(SOURCE_BLOCK).alias("block"), start.alias("place")))
    return placed.select(
        *block, PLACE, "line", "top", F.coalesce(start, "earlier").alias("first"),
        (F.col("inside") == begins).alias("own"), (F.col("inside_after") != begins).alias("open_after"),
    )


def records(spark: SparkSession, path: str, most: int = MAX_RECORD_BYTES) -> DataFrame:
    """source_file, source_block, source_place, record, open, top: the CSV records of the files at ``path``, headers
    included; ``open`` marks single lines of a record longer than ``most`` bytes, ``top`` a file's first record. The files
    are not read again later."""
    with short_shuffles(spark):
        lines = _with_starts(spark, path)
        single = F.col("own") & ~F.col("open_after")
        whole = lines.filter(single).select(SOURCE_FILE, SOURCE_BLOCK, PLACE, F.col("line").alias("record"), "top")
        several = lines.filter(~single).select(SOURCE_FILE, SOURCE_BLOCK, PLACE, "line", "first", "top")
        by = [SOURCE_FILE, "first"]
        sizes = several.groupBy(*by).agg(F.sum(F.octet_length("line") + 1).alias("size"))
        too_long = staged(sizes.filter(F.col("size") > most).select(*by), "csv-open")
        none = too_long.isEmpty()
        closed = several if none else several.join(too_long, by, "left_anti")
        parts = F.array_sort(F.collect_list(F.struct(SOURCE_BLOCK, PLACE, "line")))
        joined = (
            closed.groupBy(*by)
            .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"), F.bool_or("top").alias("top"))
            .select(SOURCE_FILE, F.col("first.block").alias(SOURCE_BLOCK), F.col("first.place").alias(PLACE), "record", "top")
        )
        out = whole.unionByName(staged(joined, "csv-records")).withColumn("open", F.lit(False))
        if not none:
            left_open = several.join(too_long, by, "left_semi")
            left_open = left_open.select(SOURCE_FILE, SOURCE_BLOCK, PLACE, F.col("line").alias("record"), "top")
            out = out.unionByName(staged(left_open, "csv-open-lines").withColumn("open", F.lit(True)))
    # Windows line ends: the break before the line feed is no part of the record.
    return out.withColumn("record", F.regexp_replace("record", "\r$", ""))
