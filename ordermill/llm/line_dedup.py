"""Operator 7 [native]: line deduplication over levelled sorted runs of line hashes.

Documents arrive in batches (by hash of doc_id, or a batch column of the
caller's). The index of lines seen so far is a set of *runs*: tables bucketed
and sorted by the 128-bit hash of a line's key. A new batch, aggregated to one
row per key, is merge-anti-joined with every run: its unseen keys become a run
of level 0, its seen keys are logged as repeats. When ``fanout`` runs stand on
one level they are merged into one run of the next, so that a batch meets at
most (fanout - 1) runs a level, a logarithmic number in all. Runs hold disjoint
keys; runs and repeats together give each key's number of documents and its
largest doc_id.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. Keys of at least ``min_chars`` code points that ``min_docs``
documents hold lose all their lines except those of the largest doc_id.

Only DataFrame operations are used. A key that a third of all lines share is
reduced before each shuffle (one row per task), and the join that marks its
lines is one that AQE splits.

Defined cases: a null text counts as one empty line and stays null; an empty
text is one empty line; rows with a null doc_id count as one document that
ranks below all others; rows with the same doc_id are one document; repeated
rows are returned as often as they come; an empty table gives an empty result;
other columns pass through, helper columns never clash with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import fresh_names, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRIPPED = "\x20\x09\x0a\x0b\x0c\x0d"
NO_ID = -(1 << 63)


class RunIndex:
    """The levelled runs of one deduplication, as bucketed tables below the shared work folder."""

    def __init__(self, spark: SparkSession, fanout: int, buckets: int):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.levels: list[list[str]] = []
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, "h1", "h2")
            .write.option("path", work_path(self.spark, name))
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .saveAsTable(name)
        )
        self.made.append(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is in no run."""
        for name in self.runs():
            rows = rows.join(self.spark.table(name).select("h1", "h2"), ["h1", "h2"], "left_anti")
        return rows

    def add(self, rows: DataFrame) -> str:
        """A run of level 0 of keys that no run holds; full levels are merged upwards."""
        added = name = self._write(rows)
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(name)
            if len(self.levels[level]) < self.fanout:
                return added
            merged = self.spark.table(self.levels[level][0])
            for other in self.levels[level][1:]:
                merged = merged.unionByName(self.spark.table(other))
            name = self._write(merged)
            self.levels[level] = []
            level += 1

    def rows(self) -> DataFrame | None:
        out = None
        for name in self.runs():
            run = self.spark.table(name)
            out = run if out is None else out.unionByName(run)
        return out

    def drop(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_key(line: Column) -> Column:
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(STRIPPED))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def common_lines(lines: DataFrame, batches: int, fanout: int, min_docs: int) -> DataFrame:
    """Staged (h1, h2, last): keys of ``lines`` (batch, h1, h2, doc) that ``min_docs`` documents hold."""
    spark = lines.sparkSession
    index = RunIndex(spark, fanout, int(spark.conf.get("spark.sql.shuffle.partitions")))
    repeats: DataFrame | None = None
    for batch in range(batches):
        keys = staged(
            lines.filter(F.col("batch") == batch)
            .select("h1", "h2", "doc")
            .distinct()
            .groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last")),
            "batch-lines",
        )
        new = index.add(index.unseen(keys)) if batch else index.add(keys)
        if batch:
            seen = keys.join(spark.table(new).select("h1", "h2"), ["h1", "h2"], "left_anti")
            repeats = seen if repeats is None else repeats.unionByName(seen)
    held = index.rows()
    if repeats is not None:
        held = held.unionByName(repeats)
    out = staged(
        held.groupBy("h1", "h2")
        .agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        .filter(F.col("docs") >= min_docs)
        .select("h1", "h2", "last"),
        "common-lines",
    )
    index.drop()
    return out


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """``docs`` with common lines taken out of ``text``; adds n_lines and n_dropped (long), the
    numbers of lines before and dropped. If ``docs`` has columns of these names they are replaced."""
    docs = docs.drop("n_lines", "n_dropped")
    as_text = F.col("text").cast("string")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("doc_id", as_text).alias("r1"),
        F.xxhash64(F.lit(1), "doc_id", as_text).alias("r2"),
        F.posexplode(F.split(F.translate(as_text, UPPER, LOWER), "\n", -1)).alias("at", "line"),
    )
    key = F.btrim("line", F.lit(STRIPPED))
    lines = staged(
        rows.withColumn("line", key)
        .filter(F.char_length("line") >= min_chars)
        .select(
            F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int").alias("batch"),
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(1), "line").alias("h2"),
            "doc",
            "r1",
            "r2",
            "at",
        ),
        "lines",
    )
    common = common_lines(lines, batches, fanout, min_docs)
    names = fresh_names(docs, ["r1", "r2", "gone", "lines"])
    gone = (
        lines.join(common, ["h1", "h2"])
        .filter(F.col("doc") != F.col("last"))
        .groupBy(F.col("r1").alias(names["r1"]), F.col("r2").alias(names["r2"]))
        .agg(F.collect_set("at").alias(names["gone"]))
    )
    marked = docs.withColumns(
        {names["r1"]: F.xxhash64("doc_id", as_text), names["r2"]: F.xxhash64(F.lit(1), "doc_id", as_text)}
    ).join(gone, [names["r1"], names["r2"]], "left")
    marked = marked.withColumn(names["lines"], _lines(as_text))
    dropped = F.coalesce(F.size(names["gone"]), F.lit(0))
    places = F.array_except(F.sequence(F.lit(0), F.size(names["lines"]) - 1), F.col(names["gone"]))
    # element_at counts from 1.
    kept = F.array_join(F.transform(places, lambda i: F.element_at(F.col(names["lines"]), i + 1)), "\n")
    return marked.select(
        *[F.when(dropped > 0, kept).otherwise(as_text).alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.size(names["lines"]).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )
