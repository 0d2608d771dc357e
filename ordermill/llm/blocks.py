"""Documents in blocks of bounded size, and a corpus-wide dictionary looked up once per block.

An operator that needs a corpus-wide figure for every word or pair of a text
would send each occurrence to its key and back. Here a task turns about
``BLOCK_BYTES`` of text into one row: the block's distinct keys as an array, and
whatever the operator needs to go on, referring to keys by their place. Only the
distinct keys of a block meet the dictionary; what is found returns to the block
in one cogroup. A key that is in every block is a hot key of that join with one
row a block; its other side has one row, so adaptive execution splits it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a block, and bytes that are worked on at a time.
BLOCK_BYTES, PIECE_BYTES = 4 << 20, 1 << 20


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id (bigint) and text (string, null as empty) of ``docs``, and nothing else."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def text_blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The rows of an Arrow iterator in tables of about ``most`` bytes of text, at least one row each."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column("text"))) + 16
        start = 0
        for i, size in enumerate(sizes.tolist()):
            total += size
            if total >= most:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, total, start = [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def block_numbers() -> Iterator[int]:
    """Numbers of this task's blocks, distinct over all tasks of a stage."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    while True:
        yield first
        first += 1


def gather(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Concatenated rows of a ragged table: row r is flat[starts[r] : starts[r + 1]]."""
    sizes = starts[rows + 1] - starts[rows]
    return flat[spans(starts[rows], sizes)]


def spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (sizes[0] numbers), then those of the next span."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - sizes), sizes) + np.arange(total)


def segment_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` for each of ``n`` groups, as 64-bit integers."""
    sums = np.r_[0, np.cumsum(values.astype(np.int64))]
    ends = np.searchsorted(groups, np.arange(n + 1))
    return sums[ends[1:]] - sums[ends[:-1]]


def planes(values: np.ndarray, width: int) -> bytes:
    """Small non-negative numbers as ``width`` byte planes, low bytes first, compressed: high planes are mostly
    zero."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes(), 1)


def from_planes(data: bytes, width: int) -> np.ndarray:
    cut = np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((cut.shape[1], 4), np.uint8)
    out[:, :width] = cut.T
    return out.view("<u4").ravel().astype(np.int64)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<boolean>": pa.list_(pa.bool_()), "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def one_row(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def looked_up(
    blocks: DataFrame, keys: str, table: DataFrame, key: str, finish: Callable[[pa.Table, pa.Table], pa.Table], schema
) -> DataFrame:
    """For every block, ``finish(block row, what was found)``.

    ``blocks`` has ``block`` and the array column ``keys``; ``table`` has one row per ``key``. What was found is
    one row (place, the other columns of ``table``) per key of the block that ``table`` holds, in any order.
    """
    places = blocks.select(F.col("block").alias("of_block"), F.posexplode(keys).alias("place", key))
    found = places.join(table, key).drop(key)
    rest = blocks.drop(keys)
    return rest.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(finish, schema)
