"""Operator 10: benchmark decontamination by greedy string tiling.

A document covers a benchmark item as far as non-overlapping runs of at least
``min_match`` equal words (tiles) can be laid over both, longest first, in any
order: a passage cut up and reordered still counts. Per document:

1. seeds: the item's ``min_match``-word hashes are joined with the documents';
   a pair that shares too few of them for ``percent`` % of the item is out;
2. tiling: running Karp-Rabin hashes of the seeded stretches find the greatest
   length at which unmarked words of both still match (by bisection, matches of
   a length imply matches of every smaller one); all matches of that length are
   marked in order of (item position, document position) unless they overlap a
   marked word; then again, until no match of ``min_match`` words is left;
3. the item is found when marked words make up ``percent`` % of it.

Words are separated by ``[\\x20\\x09-\\x0D]``; A-Z are lower-cased and ASCII
punctuation is removed before comparing, words left empty do not count.

Spark joins and the driver holds neither items nor documents. A bitmap of the
seeds' hashes (16 MB at most, whatever the benchmark's size) goes to all tasks;
the one pass over the texts sends on only what hits it: a document's *stretches*
(positions and word hashes) and its hit seeds, once per distinct text. The
bitmap lets some strangers through and the join drops them. Tiles of W words
in all, each of ``min_match`` words or more, hold at least W / ``min_match`` seeds,
so a pair needs that many: an item leaves up to half as many of its seeds, those
that most texts hold, out of the join (a phrase that many items and documents share
pairs nobody by itself), and asks for the rest of that number. Only the pairs
that are left meet with their words, a row each, and are tiled.

Defined cases: null or empty texts, and items without words, match nothing;
items of fewer than ``min_match`` words match as a whole; repeated documents or
items give a row each; null ids are returned as null; an empty table on either
side gives no match; other columns pass through ``decontaminate`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, chunked, fresh_names, gram_hashes, signed, staged

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bits of the seeds' bitmap: about 1,024 a seed, within these powers of two.
BITMAP_BITS = (16, 27)

ITEM = "item_key binary, size int, item array<bigint>"
STRETCHES = "doc_key binary, places array<int>, words array<bigint>, seeds array<bigint>"
TILES = "tiles array<struct<item_start:int,doc_start:int,words:int>>"
COVERED = f"doc_key binary, item_key binary, item_words bigint, covered_words bigint, {TILES}"


def plain_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().translate(None, PUNCTUATION).split() if text else []


def _free_starts(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of windows of ``size`` words without a marked one."""
    if len(marked) < size:
        return np.empty(0, np.int64)
    total = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(total[size:] == total[:-size])


def _matches(item: np.ndarray, doc: np.ndarray, item_marked, doc_marked, size: int) -> list[tuple[int, int]]:
    """Unmarked equal windows of ``size`` words, by (item start, document start)."""
    here, there = _free_starts(item_marked, size), _free_starts(doc_marked, size)
    if not len(here) or not len(there):
        return []
    a, b = gram_hashes(item, size)[here], gram_hashes(doc, size)[there]
    order = np.argsort(b, kind="stable")
    lo = np.searchsorted(b[order], a, "left")
    hi = np.searchsorted(b[order], a, "right")
    return [
        (int(i), int(j))
        for i, x, y in zip(here, lo, hi, strict=True)
        for j in there[order[x:y]]
        if np.array_equal(item[i : i + size], doc[j : j + size])
    ]


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, words) of two arrays of word hashes."""
    item_marked, doc_marked = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    top = min(len(item), len(doc))
    while True:
        low, high, found = min_match, top, []
        while low <= high:
            size = (low + high) // 2
            some = _matches(item, doc, item_marked, doc_marked, size)
            if some:
                found, top, low = some, size, size + 1
            else:
                high = size - 1
        if not found:
            return tiles
        for i, j in found:
            if not item_marked[i : i + top].any() and not doc_marked[j : j + top].any():
                item_marked[i : i + top] = True
                doc_marked[j : j + top] = True
                tiles.append((i, j, top))


def item_tiles(item: np.ndarray, places: np.ndarray, words: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles of an item and a document of which ``words`` at ``places`` (rising) are known."""
    own = gram_hashes(words, size)
    whole = places[size - 1 :] - places[: len(own)] == size - 1
    hit = np.flatnonzero(whole & np.isin(own, gram_hashes(item, size)))
    if not len(hit):
        return []
    # Only stretches with the item's seeds can match; they are kept apart by a marker no word has.
    spots = np.unique((hit[:, None] + np.arange(size)).ravel())
    text, back = [], []
    for n, piece in enumerate(np.split(spots, np.flatnonzero(np.diff(places[spots]) > 1) + 1)):
        text += [words[piece], np.array([n], np.uint64)]
        back += [places[piece], np.array([-1])]
    at = np.concatenate(back)
    return [(i, int(at[j]), n) for i, j, n in tile(item, np.concatenate(text), size)]


def text_key(text: Column) -> Column:
    """128-bit name of a text."""
    return F.unhex(F.md5(text))


def _texts(rows: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return rows.filter(F.length(text) > 0).select(text_key(text).alias("key"), text.alias("text"))


def _item_words(min_match: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHashes()
        for rows in chunked(frames, lambda r: len(r[1]), 4 << 20):
            found = [(key, hasher.of(words)) for key, text in rows if (words := plain_words(text))]
            out = [(key, min(min_match, len(item)), signed(item)) for key, item in found]
            yield pd.DataFrame(out, columns=["item_key", "size", "item"])

    return run


def _item_seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in chunked(frames, lambda r: len(r[2]), 1 << 19):
        for key, size, item in rows:
            seeds, times = np.unique(gram_hashes(np.asarray(item, np.int64).view(np.uint64), size), return_counts=True)
            yield pd.DataFrame({"seed": signed(seeds), "item_key": key, "words": len(item), "size": size, "times": times})


def _position(seed: Column, bits: int) -> Column:
    """Place of a seed in a bitmap of 2^bits, from 1."""
    return F.shiftrightunsigned(seed, 64 - bits) + 1


def seed_bitmap(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of all seeds' places and the bitmap's size as a power of two; its size has a bound, the table's has none."""
    least, most = BITMAP_BITS
    bits = min(most, max(least, (1024 * seeds.count()).bit_length()))
    place = _position(F.col("seed"), bits)
    filled = (
        seeds.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for bucket, part in filled:
        start = (bucket - 1) * len(part)
        out[start : start + len(part)] = np.frombuffer(part, np.uint8)[: len(out) - start]
    return out, bits


def _stretches(bitmap, bits: int, sizes: list[int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, filled = WordHashes(), bitmap.value
        for rows in chunked(frames, lambda r: len(r[1]), 4 << 20):
            out = []
            for key, text in rows:
                words = hasher.of(plain_words(text))
                met, spots = [], []
                for size in sizes:
                    grams = gram_hashes(words, size)
                    place = grams >> np.uint64(64 - bits)
                    hit = np.flatnonzero(filled[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    met.append(grams[hit])
                    spots.append((hit[:, None] + np.arange(size)).ravel())
                places = np.unique(np.concatenate(spots))
                if len(places):
                    seeds = np.unique(np.concatenate(met))
                    out.append((key, places.astype(np.int32), signed(words[places]), signed(seeds)))
            yield pd.DataFrame(out, columns=["doc_key", "places", "words", "seeds"])

    return run


def _covered(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in chunked(frames, lambda r: 12 * len(r[2]) + 8 * len(r[5]), 4 << 20):
            out = []
            for doc_key, item_key, places, words, size, item in rows:
                item = np.asarray(item, np.int64).view(np.uint64)
                tiles = item_tiles(item, np.asarray(places), np.asarray(words, np.int64).view(np.uint64), size)
                covered = sum(n for _, _, n in tiles)
                if tiles and covered * 100 >= percent * len(item):
                    out.append((doc_key, item_key, len(item), covered, tiles))
            yield pd.DataFrame(out, columns=["doc_key", "item_key", "item_words", "covered_words", "tiles"])

    return run


def covered_items(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, percent: int = 60) -> DataFrame:
    """Staged doc_key, item_key, item_words, covered_words, tiles: a row per text of ``docs`` and item text it covers."""
    spark = docs.sparkSession
    items = staged(
        _texts(benchmark).dropDuplicates(["key"]).mapInPandas(_item_words(min_match), ITEM), "benchmark-words"
    )
    seeds = staged(
        items.mapInPandas(_item_seeds, "seed bigint, item_key binary, words int, size int, times int"),
        "benchmark-seeds",
    )
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most min_match numbers
    if not sizes:
        return staged(spark.createDataFrame([], COVERED), "covered-items")
    filled, bits = seed_bitmap(seeds)
    bitmap = spark.sparkContext.broadcast(filled)
    stretches = staged(
        _texts(docs).mapInPandas(_stretches(bitmap, bits, sizes), STRETCHES).dropDuplicates(["doc_key"]), "stretches"
    )
    hits = stretches.select("doc_key", F.explode("seeds").alias("seed"))
    # Seeds wanted of an item: its least covered words / seed size; up to half of them are left out, the commonest first.
    wanted = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("words") * percent / 100) / F.col("size")))
    spared = F.floor(wanted / 2)
    commonest = Window.partitionBy("item_key").orderBy(F.desc("texts"), "seed")
    chosen = staged(
        seeds.join(hits.groupBy("seed").agg(F.count(F.lit(1)).alias("texts")), "seed")
        .withColumn("run", F.sum("times").over(commonest.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("run") > spared)
        .select("seed", "item_key", "times", (wanted - spared).alias("least")),
        "chosen-seeds",
    )
    pairs = (
        hits.join(chosen, "seed")
        .groupBy("doc_key", "item_key", "least")
        .agg(F.sum("times").alias("met"))
        .filter(F.col("met") >= F.col("least"))
    )
    met = pairs.join(stretches, "doc_key").join(items, "item_key")
    return staged(
        met.select("doc_key", "item_key", "places", "words", "size", "item").mapInPandas(_covered(percent), COVERED),
        "covered-items",
    )


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, percent: int = 60) -> DataFrame:
    """A row per document and item it covers: doc_id, item_id, item_words, covered_words, n_tiles, coverage, tiles."""
    found = covered_items(docs, benchmark, min_match, percent)
    owners = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("doc_key")
    )
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), text_key(F.col("text").cast("string")).alias("item_key")
    )
    return (
        found.join(items, "item_key")
        .join(owners, "doc_key")
        .select(
            "doc_id",
            "item_id",
            F.col("item_words").cast("int").alias("item_words"),
            F.col("covered_words").cast("int").alias("covered_words"),
            F.size("tiles").alias("n_tiles"),
            (F.col("covered_words") / F.col("item_words")).alias("coverage"),
            "tiles",
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, percent: int = 60) -> DataFrame:
    """Rows of ``docs`` that cover no benchmark item, all columns unchanged."""
    key = fresh_names(docs, ["doc_key"])["doc_key"]
    found = staged(
        covered_items(docs, benchmark, min_match, percent).select(F.col("doc_key").alias(key)).distinct(),
        "contaminated-texts",
    )
    keyed = docs.withColumn(key, text_key(F.col("text").cast("string")))
    return keyed.join(found, key, "left_anti").select(*docs.columns)
