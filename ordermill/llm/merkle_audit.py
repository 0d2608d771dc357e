"""Operator 1: Merkle fixity audit of WARC replicas.

Each replica is a table of records: file, offset (where the record begins, by the
archive's catalogue) and payload, or length and sha256 of the payload. A record's leaf is the SHA-256 of its payload
with offset and length. Leaves of one range of ``range_bytes`` offsets, in offset
order, hash to a node; ``fanout`` neighbouring nodes, in order, hash to one of
the next level, up to one root per file. Every level is written to the shared
folder.

The audit compares the roots of two replicas and descends level by level only
into nodes whose hashes differ, down to the records: a sound file costs one
comparison. All steps are joins and aggregations on (file, node), so a file
that holds most of the bytes is spread like any other.

Defined cases: a null payload is an empty one; a null file or offset counts as
file '' or offset -1; several records at one offset form one leaf of their
count and digests, in any order, so repeated records are noticed; a file in
one replica only is reported record by record; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

CORRUPT, MISSING, EXTRA = "corrupt", "missing", "extra"


@dataclass
class MerkleTree:
    """leaves (file, offset, length, records, sha256, leaf) and levels of (file, node, hash), lowest first."""

    leaves: DataFrame
    levels: list[DataFrame]
    range_bytes: int
    fanout: int


def digested(records: DataFrame) -> DataFrame:
    """Records with length and sha256 in place of payload."""
    if "payload" not in records.columns:
        return records
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    return records.withColumns(
        {"length": F.octet_length(payload).cast("long"), "sha256": F.sha2(payload, 256)}
    ).drop("payload")


def leaves_of(records: DataFrame) -> DataFrame:
    rows = digested(records).select(
        F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"),
        F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"),
        "length",
        "sha256",
    )
    # Sums of 60-bit pieces of the digests: equal for equal records in any order, and map-side combinable.
    pieces = [
        F.sum(F.conv(F.substring("sha256", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).alias(f"s{i}")
        for i in range(5)
    ]
    held = rows.groupBy("file", "offset").agg(
        F.sum("length").alias("length"), F.count(F.lit(1)).alias("records"), F.min("sha256").alias("sha256"), *pieces
    )
    parts = ["offset", "length", "records", *(f"s{i}" for i in range(5))]
    leaf = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in parts]), 256)
    return held.select("file", "offset", "length", "records", "sha256", leaf.alias("leaf"))


def _node_hash(key: str, value: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(key, value)))
    return F.sha2(F.concat_ws(",", F.transform(ordered, lambda x: F.concat_ws(":", x[key].cast("string"), x[value]))), 256)


def _parent(fanout: int) -> Column:
    return F.when(F.col("node") < 0, F.col("node")).otherwise(F.floor(F.col("node") / fanout)).cast("long")


def _next_level(level: DataFrame, fanout: int) -> DataFrame:
    up = level.withColumn("up", _parent(fanout)).groupBy("file", "up").agg(_node_hash("node", "hash").alias("hash"))
    return staged(up.withColumnRenamed("up", "node"), "merkle-level")


def build_tree(records: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16, height: int | None = None) -> MerkleTree:
    """Tree of one replica. ``height`` forces a number of levels (at least as many as it needs)."""
    leaves = staged(leaves_of(records), "merkle-leaves")
    node = F.floor(F.col("offset") / range_bytes).cast("long")
    level = staged(
        leaves.withColumn("node", node).groupBy("file", "node").agg(_node_hash("offset", "leaf").alias("hash")),
        "merkle-level",
    )
    levels = [level]
    while len(levels) < (height or 1) or (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        levels.append(_next_level(levels[-1], fanout))
    return MerkleTree(leaves, levels, range_bytes, fanout)


def _differing(ours: DataFrame, theirs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys on which two tables have different values or only one has any."""
    left = ours.select(*keys, F.col(value).alias("ours"))
    right = theirs.select(*keys, F.col(value).alias("theirs"))
    return left.join(right, keys, "full_outer").filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select(*keys)


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = 1 << 16, fanout: int = 16) -> DataFrame:
    """Records in which the replica differs: file, offset, status (corrupt, missing, extra), expected_length,
    actual_length, expected_sha256, actual_sha256."""
    good = build_tree(primary, range_bytes, fanout)
    other = build_tree(replica, range_bytes, fanout, len(good.levels))
    while len(good.levels) < len(other.levels):
        good.levels.append(_next_level(good.levels[-1], fanout))
    top = len(good.levels) - 1
    suspects = _differing(good.levels[top], other.levels[top], ["file", "node"], "hash")
    for level in range(top - 1, -1, -1):
        parents = staged(suspects.select("file", F.col("node").alias("up")), "merkle-suspects")
        below = [t.levels[level].withColumn("up", _parent(fanout)).join(parents, ["file", "up"], "left_semi") for t in (good, other)]
        suspects = _differing(below[0], below[1], ["file", "node"], "hash")
    ranges = staged(suspects, "merkle-suspects")
    node = F.floor(F.col("offset") / range_bytes).cast("long")
    ours, theirs = (t.leaves.withColumn("node", node).join(ranges, ["file", "node"], "left_semi") for t in (good, other))
    name = lambda df, p: df.select(
        "file", "offset", *[F.col(c).alias(f"{p}_{c}") for c in ("leaf", "length", "sha256")]
    )
    return (
        name(ours, "expected")
        .join(name(theirs, "actual"), ["file", "offset"], "full_outer")
        .filter(~F.col("expected_leaf").eqNullSafe(F.col("actual_leaf")))
        .select(
            "file",
            "offset",
            F.when(F.col("actual_leaf").isNull(), MISSING)
            .when(F.col("expected_leaf").isNull(), EXTRA)
            .otherwise(CORRUPT)
            .alias("status"),
            "expected_length",
            "actual_length",
            "expected_sha256",
            "actual_sha256",
        )
    )


def warc_payload() -> Column:
    """The WARC response record of a row of pages (url, html), as text."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(F.col("url").cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def warc_layout(records: DataFrame, id_column: str, per_file: int = 512) -> DataFrame:
    """Adds file and offset to digested records: ``per_file`` consecutive ids share a file, in the order of
    (id, sha256); records without an id are spread over 64 files."""
    number = F.floor(F.col(id_column) / per_file).cast("string")
    spread = F.pmod(F.xxhash64("sha256"), F.lit(64)).cast("string")
    file = F.when(F.col(id_column).isNull(), F.concat(F.lit("none-"), spread)).otherwise(
        F.concat(F.lit("pages-"), number)
    )
    before = Window.partitionBy("file").orderBy(id_column, "sha256").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("file", file).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))
    )
