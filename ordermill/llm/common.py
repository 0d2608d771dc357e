"""Words, hashes and staged tables shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Entries a worker's word cache may hold before it starts anew.
CACHE_WORDS = 1 << 19

MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
#: Base of the running hash, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    for paths in _noted:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_noted: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that ``staged`` writes meanwhile, for a caller that can tell when they are no longer read."""
    paths: list[str] = []
    _noted.append(paths)
    try:
        yield paths
    finally:
        _noted.pop()


def id_text(column: str) -> Column:
    """A bigint id as text: pandas holds bigints beside nulls as floats, which lose ids from 2^53 on."""
    return F.col(column).cast("long").cast("string").alias(column)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words between characters \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "replace").lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, with a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, size: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    return np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes, in order; long runs are differences of sums of powers."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    if n > len(MULTIPLIERS):
        sums = np.r_[np.uint64(0), np.cumsum(hashes * _powers(BASE, len(hashes)), dtype=np.uint64)]
        return mix((sums[n:] - sums[:-n]) * _powers(UNBASE, size) + np.uint64(n))
    total = np.full(size, np.uint64(n), np.uint64)
    for j in range(n):
        total += hashes[j : j + size] * MULTIPLIERS[j]
    return mix(total)


def shingle_set(found: list[bytes], hasher: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer than ``n`` words the whole sequence is one shingle."""
    if not found:
        return np.empty(0, np.uint64)
    hashes = hasher.of(found)
    return np.unique(gram_hashes(hashes, min(n, len(hashes))))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def fresh_names(df: DataFrame, wanted: list[str]) -> dict[str, str]:
    """For each wanted helper column a name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in wanted:
        fresh = name
        while fresh.lower() in taken:
            fresh += "_"
        taken.add(fresh.lower())
        out[name] = fresh
    return out


def chunked(frames: Iterator, size_of, most: int) -> Iterator[list]:
    """Rows of an iterator of pandas frames (as tuples) in lists whose sizes sum to about ``most``."""
    held: list = []
    total = 0
    for frame in frames:
        for row in frame.itertuples(index=False, name=None):
            held.append(row)
            total += size_of(row)
            if total >= most:
                yield held
                held, total = [], 0
    if held:
        yield held
