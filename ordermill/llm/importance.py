"""Target-distribution importance resampling over hashed word n-grams.

A feature is a run of 1..``order`` consecutive words; its bucket is the CRC-32
of its bytes modulo ``buckets``. A bucket's gain compares how often the target
corpus and the whole input hold it; a document's weight is the sum of the gains
of its features, and Gumbel noise from a hash of its id turns the weights into a
draw without replacement: the highest scores are the sample.

**CRC-32 from a position table.** A CRC is linear over exclusive or: the CRC of
n bytes is that of n zero bytes (a length constant) XOR one contribution per
byte, which depends on the byte and its distance from the end. ``TABLE`` holds
these contributions for distances up to ``SPAN``; ``crc32_spans`` looks up all
bytes of all features at once and reduces each feature's span with
``bitwise_xor.reduceat``. A longer span is cut into blocks of ``SPAN`` bytes
from its end, which are folded from the front: the state so far is moved on by
``SPAN`` zero bytes (four table lookups) and XORed with the next block.

**At scale.** Bucket counts are summed in each task and then in Spark; the gains
are ``buckets`` numbers, a bound that is a parameter, and travel with the tasks.
Ranks come from a range partitioning on (score, doc_id): each range is numbered
on its own and moved on by the sizes of the ranges before it, so no task sorts
more than a range. Equal scores are parted by doc_id, so no range is stuck with
one score.

Defined cases: a null or empty text has no features, weight 0 and no rank; texts
of any length count as a whole. Rows with one doc_id are rows of their own (each
may be drawn); a null doc_id is hashed as the empty text and comes last among
equal scores. Other columns are ignored. An empty target or input table gives
counts of zero.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import doc_texts, segment_sums, spans, text_blocks
from .common import fresh_names, staged

#: Bytes the position table reaches from a span's end; bytes looked up at a time.
SPAN, STEP = 64, 1 << 19
_POLY = 0xEDB88320


def _byte_table() -> np.ndarray:
    """The register after one byte, from a register of zero."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(_POLY), table >> np.uint32(1))
    return table


def _position_table(span: int) -> np.ndarray:
    """table[d, b]: what byte b, d bytes before the end, adds to the register."""
    one = _byte_table()
    rows = [one]
    for _ in range(span - 1):
        last = rows[-1]
        rows.append(one[last & 255] ^ (last >> np.uint32(8)))
    return np.array(rows, np.uint32)


TABLE = _position_table(SPAN)
#: Register after n zero bytes from the initial register, n <= SPAN: the length constants.
LENGTH = np.array([zlib.crc32(bytes(n)) ^ 0xFFFFFFFF for n in range(SPAN + 1)], np.uint32)


def _moved_on(register: np.ndarray) -> np.ndarray:
    """Registers after SPAN more zero bytes: the register's four bytes are bytes SPAN..SPAN-3 before the end."""
    out = np.zeros_like(register)
    for i in range(4):
        out ^= TABLE[SPAN - 1 - i, (register >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of data[start:end] for each span."""
    sizes = ends - starts
    blocks = np.maximum(1, -(-sizes // SPAN))
    first = np.r_[0, np.cumsum(blocks)]
    # Blocks of all spans: the first of a span may be short, the others have SPAN bytes.
    number = spans(np.zeros(len(sizes), np.int64), blocks)
    block_end = np.repeat(ends, blocks) - (np.repeat(blocks, blocks) - 1 - number) * SPAN
    block_start = np.maximum(np.repeat(starts, blocks), block_end - SPAN)
    raw = _block_registers(data, block_start, block_end)
    register = raw[first[:-1]] ^ LENGTH[block_end[first[:-1]] - starts]
    more = np.flatnonzero(blocks > 1)
    step = 1
    while len(more):
        register[more] = _moved_on(register[more]) ^ raw[first[more] + step]
        step += 1
        more = more[blocks[more] > step]
    return register ^ np.uint32(0xFFFFFFFF)


def _block_registers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; spans have at most SPAN bytes and may be empty."""
    sizes = ends - starts
    out = np.zeros(len(sizes), np.uint32)
    filled = np.flatnonzero(sizes)
    upto = np.cumsum(sizes[filled])
    at = 0
    while at < len(filled):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP, "right")))
        some = filled[at:stop]
        size = sizes[some]
        place = spans(starts[some], size)
        distance = np.repeat(ends[some] - 1, size) - place
        out[some] = np.bitwise_xor.reduceat(TABLE[distance, data[place]], np.cumsum(size) - size)
        at = stop
    return out


#: Bytes that belong to words, once A-Z are lower-cased: digits, a-z and all bytes of other characters.
WORD_BYTE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER_BYTE = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Words:
    """The words of a batch of texts, one space between those of a text."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        raw = LOWER_BYTE[raw]
        inside = WORD_BYTE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begin = np.flatnonzero(inside & (edge[:-1] | ~np.r_[False, inside[:-1]]))
        end = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False])) + 1
        size = end - begin
        self.n = len(texts)
        self.owner = np.searchsorted(offsets, begin, "right") - 1
        self.starts = np.cumsum(size + 1) - (size + 1)
        self.ends = self.starts + size
        self.data = np.full(int(self.ends[-1]) + 1 if len(size) else 0, 32, np.uint8)
        self.data[spans(self.starts, size)] = raw[spans(begin, size)]

    def features(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, CRC-32) of the runs of 1..order words, one order at a time."""
        for k in range(order):
            size = len(self.owner) - k
            if size <= 0:
                return
            same = np.flatnonzero(self.owner[:size] == self.owner[k:])
            yield self.owner[same], crc32_spans(self.data, self.starts[same], self.ends[same + k])


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def bucket_counts(texts: DataFrame, order: int, buckets: int) -> DataFrame:
    """bucket, n: features of all texts in each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in text_blocks(batches, STEP):
            words = Words(table.column("text").combine_chunks())
            for _, crc in words.features(order):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": found.astype(np.int32), "n": total[found]})

    counted = _texts(texts).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, order: int, buckets: int) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln of its smoothed share in the target over that in the documents)."""
    spark = docs.sparkSession
    s, t = bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets)
    both = (
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(s.withColumnRenamed("n", "s"), "bucket", "left")
        .join(t.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    )
    both = staged(both, "bucket-counts")
    sums = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1.0) * (F.lit(sums.s) + float(buckets))) / (
        (F.col("s") + 1.0) * (F.lit(sums.t) + float(buckets))
    )
    # ``buckets`` rows.
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row.bucket] = row.gain
    return out


def weighted(docs: DataFrame, gain: np.ndarray, order: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.uint32(len(gain))
        for table in text_blocks(batches, STEP):
            words = Words(table.column("text").combine_chunks())
            n = words.n
            features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for owner, crc in words.features(order):
                features += np.bincount(owner, minlength=n)
                weight += segment_sums(gain[crc % buckets], owner, n)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    pa.array(np.bincount(words.owner, minlength=n)), pa.array(features), pa.array(weight),
                ],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return doc_texts(docs).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(key: str, seed: int):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("seed:key")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def ranked(df: DataFrame, takes_part: str, order: list, most: int, rank: str = "rank") -> DataFrame:
    """``df`` with the place of each row among those that take part, 1 to ``most`` (others null), in ``order``.

    Rows are cut into ranges by sampled bounds and written once with their range;
    ranges are numbered on their own.
    """
    spark = df.sparkSession
    names = fresh_names(df, ["part", "before"])
    part, before = names["part"], names["before"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, F.desc(takes_part), *order).withColumn(part, F.spark_partition_id())
    cut = staged(cut, "ranges")
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    sizes = cut.groupBy(part).agg(F.count_if(F.col(takes_part)).alias("rows"))
    sizes = sizes.select(part, F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias(before))
    place = F.col(before) + F.row_number().over(Window.partitionBy(part).orderBy(F.desc(takes_part), *order))
    out = cut.join(sizes, part).withColumn(rank, place)
    drawn = F.col(takes_part) & (F.col(rank) <= most)
    return out.withColumn(rank, F.when(drawn, F.col(rank))).drop(part, before)


def resample(
    docs: DataFrame,
    target: DataFrame,
    order: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank: of the documents with at least ``min_words``
    words, floor(percent / 100) of them are drawn by their score."""
    scored = weighted(docs, gains(docs, target, order, buckets), order)
    scored = staged(
        scored.withColumn("score", F.col("weight") + noise("doc_id", seed)).withColumn(
            "takes_part", F.col("n_words") >= min_words
        ),
        "weighted-documents",
    )
    most = percent * scored.filter("takes_part").count() // 100
    order_by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    out = ranked(scored, "takes_part", order_by, most)
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
