"""Text parsing shared by CSV reads, validation and message decoding.

Each parser trims and casts with ``try_cast``: what Spark cannot read as the type
(``2.5`` or ``99999999999`` as a 32-bit integer, ``NaN`` as a decimal) is NULL.
Decimals may be written ``5.``, ``.5``, ``1e3``; dates ``2025-1-3`` or with a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PRICE_TYPE

PRICE = PRICE_TYPE.simpleString()


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row.

    The optimizer copies a column's expression into each filter and each field read
    from it, so a text would be parsed as often. It copies nothing out of a generator;
    this one gives one row for each.
    """
    names = iter(columns.items())
    name, value = next(names)
    if len(columns) == 1:
        return df.select("*", F.explode(F.array(value)).alias(name))
    whole = F.struct(value.alias(name), *[c.alias(n) for n, c in names])
    return df.select("*", F.inline(F.array(whole)))


def blank(col: Column) -> Column:
    """NULL or the empty string: a required field that was not supplied."""
    return col.isNull() | (col == F.lit(""))


def parse_long(col: Column) -> Column:
    return F.trim(col).try_cast("bigint")


def parse_int(col: Column) -> Column:
    return F.trim(col).try_cast("int")


def parse_decimal(col: Column, target: str = PRICE) -> Column:
    return F.trim(col).try_cast(target)


def parse_truncated_int(col: Column) -> Column:
    """Decimal text truncated toward zero ("15.0" -> 15); NULL when not numeric."""
    return F.trim(col).try_cast("decimal(38,6)").try_cast("int")


def parse_date(col: Column) -> Column:
    return F.trim(col).try_cast("date")
