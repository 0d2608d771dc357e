"""Exact decimal rounding helpers.

Marts round averages and rates half-up (away from zero). Rounding an already
rounded decimal quotient can be off by one unit, so averages are computed from
exact integer sums: ``round(num / den, s) = (2*10^s*|num| + den) div (2*den)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Revenue of a line: any quantity (32 bits) times any price that PRICE_TYPE holds fits.
MONEY = "decimal(33,2)"
MONEY_SUM = "decimal(38,2)"


def half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` half away from zero for integral num, den > 0.

    Returns ``decimal(38, scale)``; NULL when ``den`` is 0 or NULL.
    """
    k = 10**scale
    n = F.abs(num).cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    top = n * F.lit(2 * k) + d
    bottom = d * F.lit(2)
    # exact integral quotient: (top - top mod bottom) divides evenly
    whole = ((top - F.pmod(top, bottom)) / bottom).cast("decimal(38,0)")
    signed = F.when(num < 0, -whole).otherwise(whole)
    return F.when(d > 0, (signed / F.lit(k)).cast(f"decimal(38,{scale})"))


def cents(amount: Column) -> Column:
    """Money amount with scale 2 as an exact integral number of cents."""
    return (amount * F.lit(100)).cast("decimal(38,0)")


def money_ratio(total_cents: Column, den: Column) -> Column:
    """Money amount ``total_cents / den`` (cents -> currency), 2 dp half-up."""
    return half_up_ratio(total_cents, den.cast("decimal(38,0)") * F.lit(100), 2)
