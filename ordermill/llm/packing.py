"""Operator 5: conflict-constrained best-fit packing of documents into bins.

A bin holds up to ``capacity`` words and no two documents of one source or of
one duplicate cluster. Documents are dealt by hash into shards of about
``SHARD_ROWS`` rows; each shard is one group of a Spark job and is packed by
itself, longest documents first. Bins stand in the order of their residual
capacity and carry a bitmap of the sources and one of the clusters they hold
(bit positions are local to the shard). The successor search starts at the least
residual that fits the document and goes on, bin by bin, until it finds the
tightest compatible one; without one a bin is opened.

A source or cluster that holds a third of all rows is spread over all shards by
the hash; equal rows are counted before the shuffle and their copies dealt apart.

Defined cases: documents longer than ``capacity`` are cut: each full piece fills
a bin of its own, the rest is packed; a document without words gets one row
without a bin; a null source or cluster conflicts with nothing; null and
repeated doc_ids are packed row by row; ties go by (doc_id, copy); an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

#: Rows of a shard on average.
SHARD_ROWS = 4096
SPACE = " \t\n\x0b\f\r"

#: Columns that may be null leave pandas as text.
PACKED = "doc_id string, copy long, piece int, words long, bin_id string, bin_offset string"


def count_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; null has none."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def content_cluster(text: Column) -> Column:
    """A cluster id that equal texts (up to case and spacing) share; null for texts without words."""
    bare = F.btrim(F.regexp_replace(F.lower(text), "[\\x20\\x09-\\x0D]+", " "), F.lit(" "))
    return F.when(F.length(bare) > 0, F.xxhash64(bare))


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (words, source bit, cluster bit), in the given order."""
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for words, source, cluster in items:
        at = bisect_left(order, (words, -1))
        while at < len(order) and (sources[order[at][1]] & source or clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            residual, chosen = order.pop(at)
        else:
            residual, chosen = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        placed.append((chosen, capacity - residual))
        sources[chosen] |= source
        clusters[chosen] |= cluster
        insort(order, (residual - words, chosen))
    return placed


def _text_numbers(values: pd.Series) -> list[int | None]:
    """Bigints from their texts; pandas would make floats of bigints beside nulls."""
    return [None if pd.isna(v) else int(v) for v in values]


def _bits(values: list) -> list[int]:
    seen: dict = {}
    return [0 if v is None else 1 << seen.setdefault(v, len(seen)) for v in values]


def _longest_first(row: tuple) -> tuple:
    doc, copy, words, tail, _, cluster = row
    return -tail, doc is None, doc or 0, cluster is None, cluster or 0, words, copy


def _pack(capacity: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        words = shard["words"].tolist()
        sources = [None if pd.isna(s) else s for s in shard["source"]]
        columns = _text_numbers(shard["doc_id"]), shard["copy"].tolist(), words, [w % capacity for w in words]
        rows = sorted(zip(*columns, sources, _text_numbers(shard["cluster"]), strict=True), key=_longest_first)
        first = int(shard["shard"].iloc[0]) << 32
        rest = [r for r in rows if r[3]]
        bits = list(zip([r[3] for r in rest], _bits([r[4] for r in rest]), _bits([r[5] for r in rest]), strict=True))
        placed = best_fit(bits, capacity)
        bins = 1 + max((b for b, _ in placed), default=-1)
        out = []
        tails = iter(placed)
        for doc, copy, size, tail, *_ in rows:
            doc = None if doc is None else str(doc)
            full = size // capacity
            for piece in range(full):
                out.append((doc, copy, piece, capacity, str(first + bins), "0"))
                bins += 1
            if tail:
                chosen, offset = next(tails)
                out.append((doc, copy, full, tail, str(first + chosen), str(offset)))
            elif not size:
                out.append((doc, copy, 0, 0, None, None))
        return pd.DataFrame(out, columns=["doc_id", "copy", "piece", "words", "bin_id", "bin_offset"])

    return run


def pack_documents(docs: DataFrame, capacity: int = 2048, words=None, source="source", cluster=None) -> DataFrame:
    """doc_id, copy, piece, words, bin_id, bin_offset: where each piece of each row of ``docs`` lies.

    ``words`` and ``cluster`` are columns; by default the words of ``text`` are
    counted and equal texts form a cluster. ``copy`` numbers equal rows.
    """
    text = F.col("text").cast("string")
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (count_words(text) if words is None else F.coalesce(words.cast("long"), F.lit(0))).alias("words"),
            F.col(source).cast("string").alias("source"),
            (content_cluster(text) if cluster is None else cluster.cast("long")).alias("cluster"),
        )
        .groupBy("doc_id", "words", "source", "cluster")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    total = docs.count()
    shards = max(1, -(-total // SHARD_ROWS))
    dealt = (
        rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "words", "source", "cluster", "copy"), F.lit(shards)))
        .select("shard", id_text("doc_id"), "words", "source", id_text("cluster"), "copy")
    )
    packed = dealt.groupBy("shard").applyInPandas(_pack(capacity), PACKED)
    return packed.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "bin_id", "bin_offset")})
