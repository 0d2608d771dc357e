"""Running totals along a per-group sequence that stay balanced when one group is huge.

``sum(value) over (partition by g order by seq, tie rows unbounded preceding)``
puts a whole group in one task. Here the sequence is cut into blocks of
``block`` consecutive positions: block totals come from a partial aggregation,
block offsets from a window over one row per block, and the running total inside
a block from a window over at most ``block`` positions. With positions that are
unique and not NULL, as an order number or an order id of one customer is, no
task holds more than one block of a group, however large. Rows that share a
position, or have none, share a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096


def blocked_running_sum(
    df: DataFrame,
    group: list[str],
    seq: str,
    tie: list[str],
    value: str,
    out: str,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``group`` in (``seq``, *``tie``) order.

    ``seq`` is an integral position (1, 2, 3, ... per group); positions may repeat,
    ``tie`` orders rows sharing a position.
    """
    # A NULL position sorts first, like the plain window: it goes to block -1.
    position = F.floor((F.col(seq) - F.lit(1)) / F.lit(block))
    blocked = df.withColumn("_block", F.coalesce(position, F.lit(-1)))
    keys = [*group, "_block"]
    # Inside-block running sum first: its exchange on (group, block) also serves the
    # block totals below, which then aggregate without another shuffle.
    inside = Window.partitionBy(*keys).orderBy(seq, *tie).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumn("_local", F.sum(value).over(inside))
    totals = local.groupBy(*keys).agg(F.sum(value).alias("_block_total"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_block_total").over(before), F.lit(0)).alias("_offset"))
    local = local.alias("_l")
    offsets = offsets.alias("_o")
    # NULL-safe keys: a group whose key is NULL is still one group, as in the window.
    on = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_o.{k}")) for k in keys]
    joined = local.join(offsets, on)
    return joined.select(
        *[F.col(f"_l.{c}") for c in df.columns],
        (F.col("_o._offset") + F.col("_l._local")).alias(out),
    )
