"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC day-grain dates, ANSI casts, adaptive execution.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ordermill",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one gets a private folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="ordermill-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Codec of what is written to be read again: half of Spark's default codec in size.
CODEC = "zstd"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared work folder."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; the session's own come back afterwards. A stream started in here keeps these."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that wrote them; by default they stay until the driver collects garbage."""
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        yield


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "spark.sql.streaming.stateStore.rocksdb"
#: A stream's state in files of the executors' local folders, with a bounded share of memory beside the heap. Spark's
#: default keeps each key as objects on the heap, and those of a stopped query beside those of the next.
STATE_ON_DISK = {
    STATE_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.boundedMemoryUsage": "true",
    f"{_STATE}.maxMemoryUsageMB": "256",
    # Without a count of all keys no key is read only to be counted.
    f"{_STATE}.trackTotalNumberOfRows": "false",
    # A stopped query's local files go when its stores are next looked after, by default each minute.
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def state_on_disk(spark: SparkSession) -> dict[str, str]:
    """STATE_ON_DISK, as far as the session doesn't say otherwise. A checkpoint that was begun with another provider
    keeps that."""
    return {key: spark.conf.get(key, value) for key, value in STATE_ON_DISK.items()}


BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that a Python worker is handed at a time.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Python workers get rows in batches of BATCH_BYTES, unless the session sets a size: Spark's 10,000 rows are tens of
    MB of whole texts, in the worker and beside the executor's heap. It stays set, as frames are evaluated later; the size
    of a batch changes no result."""
    if spark.conf.get(BATCH_SIZE, None) is None:
        spark.conf.set(BATCH_SIZE, str(BATCH_BYTES))


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    target, store = _file_system(spark, path)
    return [f.getPath().getName() for f in store.listStatus(target) if f.isDirectory()] if store.exists(target) else []


def delete_below(spark: SparkSession, root: str, path: str) -> None:
    """Remove a folder below ``root``; others are refused."""
    if not path.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {root}")
    target, store = _file_system(spark, path)
    store.delete(target, True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a work folder of ``work_path``; other folders are refused."""
    delete_below(spark, shared_root(spark), path)
