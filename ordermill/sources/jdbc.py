"""JDBC sink for marts: replace table contents while keeping the table's DDL."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame

from .contracts import as_table, stamp

SETTINGS = ("POSTGRES_HOST", "POSTGRES_PORT", "POSTGRES_DB", "POSTGRES_USER")


def connection(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection from the environment; every setting but the password must be given."""
    env = os.environ if env is None else env
    absent = [k for k in SETTINGS if not env.get(k)]
    if absent:
        raise KeyError("set " + ", ".join(absent))
    host, port, database, user = (env[k] for k in SETTINGS)
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "user": user,
        "password": env.get("POSTGRES_PASSWORD", ""),
        "driver": "org.postgresql.Driver",
    }


def writer_options(table: str, conn: Mapping[str, str], schema: str = "",
                   batch_size: int = 10_000) -> dict[str, str]:
    """``truncate`` keeps keys, NOT NULL and defaults of the existing table; plain
    overwrite would drop and recreate it from the DataFrame's types."""
    return {
        **conn,
        "dbtable": f"{schema}.{table}" if schema else table,
        "truncate": "true",
        "batchsize": str(batch_size),
    }


def write_jdbc(mart: DataFrame, table: str, conn: Mapping[str, str] | None = None, schema: str = "",
               max_connections: int = 8) -> None:
    """Overwrite a mart table, with the narrower column types the table declares and ``loaded_at``.
    At most ``max_connections`` partitions write at once.

    TRUNCATE then INSERT is not atomic: readers can see an empty table in between.
    """
    conn = connection() if conn is None else conn
    opts = writer_options(table, conn, schema)
    opts["numPartitions"] = str(max_connections)
    stamp(as_table(mart, table)).write.format("jdbc").mode("overwrite").options(**opts).save()
