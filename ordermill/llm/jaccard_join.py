"""Operator 2: n-gram Jaccard self-join with adaptive multi-match prefixes.

Two shingle sets with Jaccard similarity s or more share at least ceil(s * n)
shingles, n being either set's size. Under one global order of shingles (rare
ones first) the first n - ceil(s * n) + l of each set, its *l-prefix*, therefore
share at least l shingles. A longer prefix lists more postings but asks for
more shared shingles before a pair is verified. Each set picks the l of least
estimated cost, and a pair with prefixes l1, l2 is verified only when the two
prefixes share min(l1, l2) shingles.

The work, as Spark jobs:

1. One pass over the texts gives each row its set's size and 64-bit key; rows
   with the same set form one class. Shingles held by 1 % of a chunk's
   documents are reported as hot.
2. The shingles of the classes are dealt by hash range, packed as bytes. Each
   range counts the classes holding each shingle; those held by one class only
   go. Hot shingles are dealt by chunk instead, so none fills a task.
3. Windows per class order what remains by (frequency, hash), sum the cost of
   each l and cut the prefix.
4. Candidates: within a shingle's posting list first only pairs with three centres
   (linear in the list); the links found join classes into components. Then
   all pairs of *different* components that share enough prefix shingles, the
   largest component of a list only against the others, so that a group of
   thousands of near copies is never expanded into its pairs. Exact bounds by
   the shingles' places and by parity bitmaps of the sets drop pairs that
   cannot link while the lists are joined.
5. Every candidate is verified exactly on whole sets.

Defined cases: null or empty texts have no shingle and link with nothing; fewer
than n words make one shingle of the whole sequence; rows with a null doc_id
take part (their component_id is null if nothing else is in the component);
repeated rows are returned as often as they come; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, chunked, id_text, shingle_set, signed, staged, words
from .components import connected_components

#: Bits of a shingle's hash that are dealt: the upper 48.
TOKEN_BITS = 48
#: Shingles that one chunk of a task gathers, and that one dealt range holds on average.
CHUNK_SHINGLES = 1_500_000
RANGE_SHINGLES = 3_000_000
#: Share of a chunk's documents from which a shingle is reported as hot, and of all classes from which it is.
CHUNK_SHARE, HOT_SHARE = 0.01, 0.005
#: 64-bit words of a set's parity bitmap.
BITMAP = 16
BITS = [f"b{i}" for i in range(BITMAP)]
#: Prefix extensions tried, and cost of verifying one shingle of a pair against listing one posting.
MAX_EXTENSION, VERIFY_COST = 6, 0.05


def _hot_in_chunk(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    least = max(20, math.ceil(CHUNK_SHARE * len(arrays)))
    if len(arrays) < least:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    tokens, counts = np.unique(np.concatenate(arrays) >> np.uint64(64 - TOKEN_BITS), return_counts=True)
    return tokens[counts >= least], counts[counts >= least]


def parity_bitmap(found: np.ndarray) -> np.ndarray:
    """Bit i is set when an odd number of shingles fall on it: two bitmaps differ in at most as many bits as
    their sets differ in shingles."""
    odd = np.bincount((found & np.uint64(64 * BITMAP - 1)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets_of(shingle: int):
    """doc_id (as text), text -> doc_id, n, key, bitmap; and the chunk's hot shingles as rows with kind 1."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHashes()
        for rows in chunked(frames, lambda r: len(r[1] or "") // 6 + 1, CHUNK_SHINGLES):
            seen: dict[int, np.ndarray] = {}
            ids, sizes, keys, own, maps = [], [], [], [], []
            for doc_id, text, row_key in rows:
                found = shingle_set(words(text), hasher, shingle)
                key = xxhash.xxh64_intdigest(found.tobytes())
                if len(found):
                    seen[key] = found
                ids.append(doc_id)
                sizes.append(len(found))
                keys.append(key)
                own.append(row_key)
                maps.append(parity_bitmap(found))
            hot, counts = _hot_in_chunk(list(seen.values()))
            yield pd.DataFrame(
                {
                    "kind": np.zeros(len(ids), np.int32),
                    "doc_id": pd.array(ids, dtype="string"),
                    "n": np.array(sizes, np.int64),
                    "key": signed(np.array(keys, np.uint64)),
                    "row_key": np.array(own, np.int64),
                    **dict(zip(BITS, np.array(maps).T, strict=True)),
                }
            )
            if len(hot):
                yield pd.DataFrame(
                    {
                        "kind": np.ones(len(hot), np.int32),
                        "doc_id": pd.array([None] * len(hot), dtype="string"),
                        "n": counts.astype(np.int64),
                        "key": hot.astype(np.int64),
                        "row_key": np.zeros(len(hot), np.int64),
                        **{b: np.zeros(len(hot), np.int64) for b in BITS},
                    }
                )

    return run


def shingle_classes(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Staged rows (kind, doc_id, n, key, row_key, bitmap): kind 0 one per row of ``docs``, kind 1 reports of hot shingles."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(id_text("doc_id"), text.alias("text"), F.xxhash64(text).alias("own"))
    columns = ["kind int", "doc_id string", "n long", "key long", "row_key long", *(f"{b} long" for b in BITS)]
    found = rows.mapInPandas(_sets_of(shingle), ", ".join(columns))
    return staged(found.withColumn("doc_id", F.col("doc_id").cast("long")), "sets")


def _dealt(shingle: int, ranges: int, hot: np.ndarray):
    """Shingles of a chunk's distinct sets, packed by range; hot ones into a part of the chunk's own."""
    step = -(-(1 << TOKEN_BITS) // ranges)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHashes()
        task = TaskContext.get().partitionId()
        for number, rows in enumerate(chunked(frames, lambda r: len(r[0] or "") // 6 + 1, CHUNK_SHINGLES)):
            seen: dict[int, np.ndarray] = {}
            for (text,) in rows:
                found = shingle_set(words(text), hasher, shingle)
                if len(found):
                    seen.setdefault(xxhash.xxh64_intdigest(found.tobytes()), found)
            if not seen:
                continue
            keys = np.fromiter(seen, np.uint64, len(seen))
            arrays = [a >> np.uint64(64 - TOKEN_BITS) for a in seen.values()]
            tokens = np.concatenate(arrays)
            owner = np.repeat(np.arange(len(keys), dtype=np.int32), [len(a) for a in arrays])
            sizes = np.array([len(a) for a in arrays], np.int32)
            part = (tokens // np.uint64(step)).astype(np.int32)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
                part[hot[at] == tokens] = ranges + (task * 31 + number) % ranges
            order = np.argsort(part, kind="stable")
            tokens, owner, part = tokens[order], owner[order], part[order]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            out = []
            for lo, hi in zip(starts, np.r_[starts[1:], len(part)], strict=True):
                who, first, counts = np.unique(owner[lo:hi], return_index=True, return_counts=True)
                picked = tokens[lo:hi]
                out.append(
                    (
                        int(part[lo]),
                        keys[who].tobytes(),
                        sizes[who].tobytes(),
                        counts.astype(np.int32).tobytes(),
                        (picked & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                        (picked >> np.uint64(32)).astype(np.uint16).tobytes(),
                    )
                )
            yield pd.DataFrame(out, columns=["part", "keys", "sizes", "counts", "low", "high"])

    return run


def _shared(ranges: int, hot: np.ndarray, hot_counts: np.ndarray):
    """Of one range: (key, n, token, df) for every shingle that two classes hold."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        join = lambda c, t: np.frombuffer(b"".join(frame[c]), t)
        counts = join("counts", np.int32)
        tokens = join("low", np.uint32).astype(np.uint64) | (join("high", np.uint16).astype(np.uint64) << np.uint64(32))
        keys = np.repeat(join("keys", np.uint64), counts)
        sizes = np.repeat(join("sizes", np.int32), counts)
        order = np.lexsort((keys, tokens))
        tokens, keys, sizes = tokens[order], keys[order], sizes[order]
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1])] if len(tokens) else np.empty(0, bool)
        tokens, keys, sizes = tokens[new], keys[new], sizes[new]
        if int(frame["part"].iloc[0]) >= ranges:
            df = hot_counts[np.searchsorted(hot, tokens)]
        else:
            edge = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
            held = np.diff(np.r_[edge, len(tokens)])
            df = np.repeat(held, held)
            keep = df > 1
            tokens, keys, sizes, df = tokens[keep], keys[keep], sizes[keep], df[keep]
        return pd.DataFrame(
            {"key": signed(keys), "n": sizes.astype(np.int32), "token": tokens.astype(np.int64), "df": df.astype(np.int64)}
        )

    return run


def shared_shingles(docs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Staged (key, n, token, df, m, need): the m shared shingles of each class that shares enough to have a link."""
    facts = sets.agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("shingles"),
        F.count(F.when(F.col("kind") == 0, F.lit(1))).alias("rows"),
    ).first()
    ranges = max(16, -(-(facts["shingles"] or 0) // RANGE_SHINGLES))
    # At most 1 / HOT_SHARE times the mean set size of shingles can be hot: a bounded list.
    found = (
        sets.filter("kind = 1 and n > 0")
        .groupBy("key")
        .agg(F.sum("n").alias("held"))
        .filter(F.col("held") >= F.lit(HOT_SHARE * (facts["rows"] or 0)))
        .orderBy("key")
        .collect()
    )
    hot = np.array([r["key"] for r in found], np.int64).astype(np.uint64)
    hot_counts = np.array([r["held"] for r in found], np.int64)
    dealt = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(
        _dealt(shingle, ranges, hot),
        "part int, keys binary, sizes binary, counts binary, low binary, high binary",
    )
    rows = dealt.repartition(ranges, "part").groupBy("part").applyInPandas(
        _shared(ranges, hot, hot_counts), "key long, n int, token long, df long"
    )
    need = F.floor((F.col("n") * percent + 99) / 100).cast("int")
    return staged(
        rows.repartition(ranges, "key")
        .dropDuplicates(["key", "token"])
        .withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("key")).cast("int"))
        .withColumn("need", need)
        .filter("m >= need"),
        "shared",
    )


def prefixes(shared: DataFrame) -> DataFrame:
    """(key, n, l, token): each class's prefix under its cheapest extension l."""
    by_key = Window.partitionBy("key")
    so_far = by_key.orderBy("df", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        shared.withColumn("place", F.col("n") - F.col("m") + F.count(F.lit(1)).over(so_far))
        .withColumn("listed", F.sum(F.col("df") - 1).over(so_far))
        .withColumn("l", (F.col("place") - (F.col("n") - F.col("need"))).cast("int"))
        .filter(F.col("l") <= F.least(F.lit(MAX_EXTENSION), F.col("need")))
    )
    # Sharing l of the listed postings is at most listed / l pairs; each costs a look at the whole set.
    cost = F.col("listed") + F.lit(VERIFY_COST) * F.col("n") * F.col("listed") / F.col("l")
    best = F.min(F.when(F.col("l") >= 1, F.struct(cost.alias("cost"), F.col("l").alias("l")))).over(by_key)
    return (
        rows.withColumn("best", best["l"])
        .filter(F.col("l") <= F.col("best"))
        .select("key", "n", "m", "place", F.col("best").alias("l"), "token")
    )


def _may_link(a: str, b: str, percent: int) -> Column:
    """Bounds on two postings of one shingle, with columns n, m, place and bitmap of suffixes ``a`` and ``b``.

    The intersection is at most the lesser number of shared shingles m, at most
    what both can share before this shingle, itself, and after it, and at most half
    of what the sizes exceed the differing bits of the bitmaps; it must reach
    percent * (na + nb) / (100 + percent).
    """
    col = lambda name, side: F.col(name + side)
    before = lambda side: col("place", side) - (col("n", side) - col("m", side)) - 1
    after = lambda side: col("n", side) - col("place", side)
    most = F.least(col("m", a), col("m", b), F.least(before(a), before(b)) + 1 + F.least(after(a), after(b)))
    both = col("n", a) + col("n", b)
    differ = reduce(Column.__add__, [F.bit_count(col(bit, a).bitwiseXOR(col(bit, b))) for bit in BITS])
    return (most * (100 + percent) >= both * percent) & ((both - differ) * (100 + percent) >= both * (2 * percent))


def verified(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the threshold, with the size of the intersection.

    Shingles held by one class only cannot be in an intersection, so the shared
    ones and the sets' sizes decide exactly.
    """
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    whole = (
        shared.join(wanted, "key", "left_semi")
        .groupBy("key")
        .agg(F.max("n").alias("n"), F.collect_list("token").alias("tokens"))
    )
    left = whole.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = whole.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .select("a", "b", both.alias("common"), (F.col("na") + F.col("nb") - both).alias("joint"))
        .filter(F.col("common") * 100 >= F.col("joint") * percent)
    )


def class_links(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Staged verified links (a, b) that connect all classes which any links connect."""
    listed = prefixes(shared)
    bitmaps = sets.filter("kind = 0 and n > 0").groupBy("key").agg(*[F.min(b).alias(b) for b in BITS])
    prefix = staged(listed.join(bitmaps, "key"), "prefixes")
    # Centres of a posting list: the class with the largest share of shared shingles (the text that copies
    # were made from), the largest, and one by hash.
    row = ["key", "n", "m", "place", *BITS]
    share = F.col("m") / F.col("n")
    centres = [
        F.max(F.struct(share.alias("by"), *row)),
        F.max(F.struct(F.col("n").cast("double").alias("by"), *row)),
        F.min(F.struct(F.xxhash64("key").cast("double").alias("by"), *row)),
    ]
    some = F.array(*[F.struct(*[F.col(f"c{i}.{x}").alias(x) for x in row]) for i in range(len(centres))])
    centre = (
        prefix.groupBy("token")
        .agg(F.count(F.lit(1)).alias("held"), *[c.alias(f"c{i}") for i, c in enumerate(centres)])
        .filter("held > 1")
        .select("token", F.explode(F.array_distinct(some)).alias("c"))
        .select("token", *[F.col(f"c.{x}").alias(f"{x}_b") for x in row])
    )
    star = (
        prefix.select("token", *[F.col(x).alias(f"{x}_a") for x in row])
        .join(centre, "token")
        .filter((F.col("key_a") != F.col("key_b")) & _may_link("_a", "_b", percent))
        .select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
        .distinct()
    )
    first = staged(verified(star, shared, percent).select("a", "b"), "star-links")
    roots = connected_components(first, "a", "b")
    held = staged(
        prefix.join(roots, prefix["key"] == roots["node"], "left").select(
            *row, "l", "token", F.coalesce("root", "key").alias("root")
        ),
        "postings",
    )
    per_root = held.groupBy("token", "root").agg(F.count(F.lit(1)).alias("rows"))
    lists = (
        per_root.groupBy("token")
        .agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("rows", "root")).alias("top"))
        .filter("roots > 1")
        .select("token", F.col("top.root").alias("top"))
    )
    open_lists = held.join(lists, "token")
    side = lambda x: [*[F.col(c).alias(f"{c}_{x}") for c in [*row, "l", "root"]]]
    left = open_lists.filter("root <> top").select("token", *side("a"))
    right = open_lists.select("token", *side("b"), (F.col("root") == F.col("top")).alias("in_top"))
    rest = (
        left.join(right, "token")
        .filter("root_a <> root_b and (in_top or key_a < key_b)")
        .filter(_may_link("_a", "_b", percent))
        .groupBy(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("met"), F.min(F.least("l_a", "l_b")).alias("asked"))
        .filter("met >= asked")
    )
    second = verified(staged(rest.select("a", "b"), "rest"), shared, percent).select("a", "b")
    return staged(first.unionByName(second), "class-links")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_key, component_key, row_key.

    ``class_key`` is equal for equal shingle sets, ``component_key`` for linked
    ones; rows without shingles have null ones and their own doc_id as
    component_id. ``row_key`` is xxhash64 of the text (null as empty).
    """
    sets = shingle_classes(docs, shingle)
    shared = shared_shingles(docs, sets, shingle, percent)
    links = class_links(shared, sets, percent)
    roots = connected_components(links, "a", "b")
    rows = sets.filter("kind = 0").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("key")).alias("class_key"),
        "row_key",
    )
    classes = (
        rows.filter("class_key is not null").groupBy("class_key").agg(F.min("doc_id").alias("least"))
        .join(roots, F.col("class_key") == F.col("node"), "left")
        .select("class_key", "least", F.coalesce("root", "class_key").alias("component_key"))
    )
    least = classes.groupBy("component_key").agg(F.min("least").alias("component"))
    of_class = staged(classes.join(least, "component_key").select("class_key", "component_key", "component"), "classes")
    return rows.join(of_class, "class_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        "class_key",
        "component_key",
        "row_key",
    )
