"""Mart contracts: typed not-null columns, a unique key, and a load timestamp."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MART_COLUMNS, TABLE_TYPES, mart_schema


class ContractError(ValueError):
    """A mart breaks its contract; nothing of it was written."""


def conform(mart: DataFrame, name: str) -> DataFrame:
    """Cast to the contract's column types and order (bigint counts, decimal(38,2) money)."""
    return mart.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in mart_schema(name).fields])


def as_table(mart: DataFrame, name: str) -> DataFrame:
    """Cast to the narrower types that the database table declares. Under ANSI a value that does not fit fails
    the write instead of being truncated."""
    schema = mart_schema(name, TABLE_TYPES)
    kept = [c for c in mart.columns if c not in schema.fieldNames()]
    return mart.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *kept)


def stamp(mart: DataFrame) -> DataFrame:
    """Add ``loaded_at`` at write time."""
    return mart.withColumn("loaded_at", F.current_timestamp())


def violations(mart: DataFrame, name: str) -> DataFrame:
    """One row: mart name, rows, rows with a NULL in any column, and rows beyond the
    first per key value (0 and 0 for a mart that keeps its contract)."""
    key, columns = MART_COLUMNS[name]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return mart.agg(
        F.lit(name).alias("mart"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_null).alias("null_rows"),
        (F.count(key) - F.count_distinct(key)).alias("excess_key_rows"),
    )


def require_contract(mart: DataFrame, name: str) -> int:
    """Number of rows of a mart that keeps its contract; fails otherwise."""
    found = violations(mart, name).first()
    if found.null_rows or found.excess_key_rows:
        raise ContractError(
            f"{name}: {found.null_rows} rows with a NULL, {found.excess_key_rows} rows with a key used before"
        )
    return found.row_count
