"""Mart state that merges: sums and exact distinct values, kept per batch of lines.

A mart of a stream is not recomputed from lines. Each batch leaves two small
tables per mart, and a refresh merges those of all batches, for the keys the new
batch touches only:

* sums: one row per key (``marts.SUMS``), added up;
* sets: one row per (key, distinct measure, element). A *sparse* set holds one
  row per value. A *dense* set, whose keys hold a good part of all ids, holds one
  bitmap of 32,768 ids per row (``bitmap_bucket_number`` is the element), and
  bitmaps of one element are merged with ``bitmap_or_agg``. Which measures are
  dense is declared, since a bitmap costs 4 kB while it is worked on; results are
  exact either way.

A month's mart counts orders by their least user id, which may change with a
later batch; its state is one row per (month, order) instead (``marts.orders_of``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .marts import DISTINCT, SUMS, Mart, distinct_measures, from_orders, merged_orders, orders_of, wanted_sums, with_measures

#: Distinct measures with dense sets of bigint ids, by their mart's keys.
DENSE = {("department",): ("order_count", "product_count")}


def line_sums(lines: DataFrame, mart: Mart) -> DataFrame:
    return lines.groupBy(*mart.keys).agg(*[SUMS[s].of_lines().alias(s) for s in wanted_sums(mart)])


def merged_sums(sums: DataFrame, mart: Mart) -> DataFrame:
    merged = sums.groupBy(*mart.keys).agg(*[SUMS[s].merge(F.col(s)).alias(s) for s in wanted_sums(mart)])
    return merged.select(*[F.col(f.name).cast(f.dataType) for f in sums.schema.fields])


def _is_dense(mart: Mart, measure: str) -> bool:
    return measure in DENSE.get(mart.keys, ())


def line_sets(lines: DataFrame, mart: Mart) -> DataFrame:
    """(key, measure, element, bits): what the lines add to the mart's distinct sets."""
    keys, parts = [F.col(k) for k in mart.keys], []
    for measure in distinct_measures(mart):
        value, name = F.col(DISTINCT[measure]), F.lit(measure).alias("measure")
        if _is_dense(mart, measure):
            bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
            element = F.bitmap_bucket_number(value).cast("string").alias("element")
            part = lines.groupBy(*keys, element).agg(bits).select(*mart.keys, name, "element", "bits")
        else:
            part = lines.select(*keys, name, value.cast("string").alias("element")).distinct()
            part = part.withColumn("bits", F.lit(None).cast("binary"))
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def merged_sets(sets: DataFrame, mart: Mart) -> DataFrame:
    """One row per (key, measure, element)."""
    by = [*mart.keys, "measure", "element"]
    dense = sets.filter("bits is not null").groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))
    sparse = sets.filter("bits is null").select(*by).distinct().withColumn("bits", F.lit(None).cast("binary"))
    return sparse.unionByName(dense) if any(_is_dense(mart, m) for m in distinct_measures(mart)) else sparse


def _set_size(measure: str) -> Column:
    size = F.when(F.col("bits").isNull(), 1).otherwise(F.bitmap_count("bits"))
    return F.sum(F.when(F.col("measure") == measure, size).otherwise(0)).alias(measure)


def finished(sums: DataFrame, sets: DataFrame, mart: Mart) -> DataFrame:
    """The mart's rows of merged sums and sets."""
    counts = sets.groupBy(*mart.keys).agg(*[_set_size(m) for m in distinct_measures(mart)])
    return with_measures(sums.join(counts, list(mart.keys)), mart)


class MartState:
    """What a stream keeps of one mart: state tables by name, and how a batch adds to them."""

    def __init__(self, name: str, mart: Mart):
        self.name, self.mart = name, mart

    def tables(self) -> list[str]:
        return [f"{self.name}_orders"] if self.mart.per_order else [f"{self.name}_sums", f"{self.name}_sets"]

    def added(self, lines: DataFrame) -> dict[str, DataFrame]:
        """A batch's own part of each state table, from cleaned lines."""
        if self.mart.per_order:
            return {f"{self.name}_orders": orders_of(lines)}
        return {f"{self.name}_sums": line_sums(lines, self.mart), f"{self.name}_sets": line_sets(lines, self.mart)}

    def merged(self, table: str, rows: DataFrame) -> DataFrame:
        if table.endswith("_orders"):
            return merged_orders(rows)
        return (merged_sums if table.endswith("_sums") else merged_sets)(rows, self.mart)

    def rows(self, state: dict[str, DataFrame]) -> DataFrame:
        """The mart's rows from merged state tables."""
        if self.mart.per_order:
            return from_orders(state[f"{self.name}_orders"], self.mart)
        return finished(state[f"{self.name}_sums"], state[f"{self.name}_sets"], self.mart)
