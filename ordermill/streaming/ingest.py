"""Streaming ingest: messages -> decode -> validate -> landing table / quarantine, and the marts kept up to date.

Every micro-batch is processed with batch DataFrame operations in
``foreachBatch`` and becomes visible as a whole (``commits``): landing,
quarantine, the marts and what they rest on are committed together, after all is
written. A batch that fails leaves readers on the batch before and runs again; a
batch that was committed is not run a second time.

A batch's rows are decoded and validated once and staged; all tables are written
from there. Marts are not recomputed from lines: each batch adds sums and distinct
values (``mart_state``), and the mart rows of the keys it touches are made from
the merged state.

With ``dedup`` a message counts once. Repeats that arrive within ``RECENT`` are
dropped by the stream's own state, which is bounded by that time; older ones by
an index of message identities, cut into buckets by hash, of which a batch reads
the buckets its messages fall into.

usage: python -m ordermill.streaming.ingest (--inbox DIR | --kafka SERVERS) --out DIR [--dedup] [--marts a,b]
       python -m ordermill.streaming.ingest (--inbox DIR | --kafka SERVERS) --source CSV [--rejects DIR]
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..operators.clean import clean_orders, mart_input
from ..operators.mart_state import MartState
from ..operators.marts import REVENUE_MARTS
from ..operators.validate import REASON, annotate, rejected
from ..schema import ORDER_COLUMNS, ORDER_SCHEMA, RAW_SCHEMA, mart_schema
from ..session import build_session, remove_path, settings, short_shuffles, state_on_disk, work_path
from ..sources.contracts import conform
from ..sources.files import read_order_rows, require_sources
from ..sources.messages import (
    DEFAULT_TOPIC, MESSAGE_SCHEMA, decode_messages, encode_messages, identity, publish_kafka, read_kafka,
)
from .commits import StreamTables, Table, Version

log = logging.getLogger("ordermill.ingest")

CORRUPT = "corrupt_message"

_TEXT = [StructField(c, StringType()) for c in ("message_id", "sales_month")]
LANDED_SCHEMA = StructType([*ORDER_SCHEMA.fields, *_TEXT, StructField("batch_id", LongType())])
QUARANTINE_SCHEMA = StructType(
    [
        *RAW_SCHEMA.fields,
        *(StructField(c, StringType()) for c in (REASON, "message_key", "message_value", "message_id")),
        StructField("batch_id", LongType()),
    ]
)


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(key, value, message_id) messages from JSON-lines files arriving in ``path``.

    ``max_files_per_trigger`` throttles intake per micro-batch.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


#: Messages of one file at most: a packed file is read by one task.
MESSAGES_A_FILE = 200_000


def write_message_files(messages: DataFrame, path: str) -> None:
    """Append messages as packed JSON-lines files, the file-based stand-in for a topic; a file per task, or several of
    MESSAGES_A_FILE."""
    # Files that wait to be read once: packed quickly rather than well.
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(MESSAGES_A_FILE)}
    messages.write.mode("append").options(**options).json(path)


ADAPTIVE = {"spark.sql.adaptive.enabled": "true"}
#: Time within which the stream's own state drops repeated messages.
RECENT = "10 minutes"
#: Buckets of the identity index.
ID_BUCKETS = 32

LANDING = Table("landing", LANDED_SCHEMA, lambda rows: rows, ("sales_month",), ("order_id",))
QUARANTINE = Table("quarantine", QUARANTINE_SCHEMA, lambda rows: rows)
#: The first 16 bytes of an identity's SHA-256: two of 10^12 identities share them with a chance of about 10^-15.
IDS = Table("ids", StructType().add("id", BinaryType()).add("bucket", IntegerType()), lambda rows: rows, ("bucket",), ("id",))
COUNTS = ("read_messages", "repeated_messages", "accepted_lines", "rejected_lines")
BATCHES = Table(
    "batches",
    StructType([StructField("batch_id", LongType()), *(StructField(c, LongType()) for c in COUNTS)]),
    lambda rows: rows.coalesce(1),
)


@dataclass(frozen=True)
class IngestTargets:
    """``root`` holds all tables of one stream; ``marts`` names the marts that are kept up to date."""

    root: str
    marts: tuple[str, ...] = ()
    dedup: bool = False


def mart_table(name: str) -> Table:
    """A mart: rows by the batch that made them; of one key the newest counts."""
    keys = REVENUE_MARTS[name].keys
    columns = [*mart_schema(name).fieldNames(), "batch_id"]

    def newest(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch_id").alias("row"))
        return last.select("row.*")

    return Table(name, StructType([*mart_schema(name).fields, StructField("batch_id", LongType())]), newest, grouped=True)


def state_table(state: MartState, name: str, rows: DataFrame) -> Table:
    by = ("sales_month",) if state.mart.per_order else ()
    return Table(name, rows.schema, lambda parts: state.merged(name, parts), by, grouped=not by)


def id_column() -> Column:
    return F.substring(F.unhex(F.sha2("message_id", 256)), 1, 16)


def with_bucket(ids: DataFrame) -> DataFrame:
    return ids.withColumn("bucket", F.pmod(F.conv(F.hex(F.substring("id", 1, 2)), 16, 10).cast("int"), F.lit(ID_BUCKETS)))


def indexed(tables: StreamTables, version: Version, buckets: list[int]) -> DataFrame:
    """Identities of committed batches that lie in ``buckets``."""
    return tables.read(IDS, version).filter(F.col("bucket").isin(buckets) if buckets else F.lit(False))


def unseen(messages: DataFrame, tables: StreamTables, version: Version) -> DataFrame:
    """One message per identity that no committed batch holds; adds id and bucket."""
    known = with_bucket(messages.withColumn("message_id", identity(messages)).withColumn("id", id_column()))
    # Whole messages are brought together only if some identity repeats; as a rule the stream's state has dropped those.
    repeats = known.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    fresh = known if repeats.isEmpty() else known.dropDuplicates(["message_id"])
    if not version.of(IDS.name):
        return fresh
    # At most ID_BUCKETS numbers.
    hit = [r.bucket for r in known.select("bucket").distinct().collect()]
    # Whole messages are joined only if the index holds some of them.
    held = tables.stage(known.select("id").join(indexed(tables, version, hit).select("id"), "id", "left_semi"))
    return fresh if held.isEmpty() else fresh.join(held, "id", "left_anti")


def process_batch(targets: IngestTargets):
    """The ``foreachBatch`` function for one set of targets."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # Spark runs a stream that keeps state without adaptive execution, batch work in it as well: a write would leave
        # a file per task and partition value. Batches are plain rows here, and the setting goes back before the next.
        with settings(batch.sparkSession, ADAPTIVE if targets.dedup else {}):
            _add_batch(targets, batch, batch_id)

    return run


def _add_batch(targets: IngestTargets, batch: DataFrame, batch_id: int) -> None:
    tables = StreamTables(batch.sparkSession, targets.root)
    base = tables.live()
    if batch_id <= base.batch:
        return
    staged, counts = _stage_batch(tables, base, batch, batch_id, targets.dedup)
    added = {BATCHES.name: tables.write(BATCHES, _one_row(batch.sparkSession, batch_id, counts))}
    if staged is None or not counts["accepted_lines"] + counts["rejected_lines"]:
        # Nothing new, as in a replay: no segments without rows.
        tables.commit(batch_id, base, [BATCHES], added)
        log.info("batch %d: %s", batch_id, counts)
        return
    refused = staged.filter(F.col(REASON).isNotNull()).select(
        *ORDER_COLUMNS, REASON, F.col("key").alias("message_key"), F.col("value").alias("message_value"),
        "message_id", "batch_id",
    )
    accepted = staged.filter(F.col(REASON).isNull()).select(
        *[F.col(f"v_{c}").alias(c) for c in ORDER_COLUMNS], "message_id", "batch_id"
    )
    known: list[Table] = [LANDING, QUARANTINE, BATCHES]
    added[QUARANTINE.name] = tables.write(QUARANTINE, refused)
    added[LANDING.name] = tables.write(LANDING, accepted.withColumn("sales_month", F.trunc("order_date", "month")))
    if targets.dedup:
        known.append(IDS)
        added[IDS.name] = tables.write(IDS, staged.select("id", "bucket"))
    lines = mart_input(clean_orders(accepted.select(*ORDER_COLUMNS)))
    for name in targets.marts:
        made = _refresh(tables, base, MartState(name, REVENUE_MARTS[name]), lines, batch_id)
        known += [table for table, _ in made]
        added.update({table.name: segment for table, segment in made})
    tables.commit(batch_id, base, known, added)
    log.info("batch %d: %s", batch_id, counts)


def _stage_batch(
    tables: StreamTables, base: Version, batch: DataFrame, batch_id: int, dedup: bool
) -> tuple[DataFrame | None, dict[str, int]]:
    """The batch's new messages, decoded and annotated, written once; counts observed while they are written. A batch
    that the stream's state leaves empty is not decoded."""
    read, kept = Observation("read"), Observation("kept")
    rows = batch.observe(read, F.count(F.lit(1)).alias("n"))
    if dedup:
        # The batch itself is read once: it may come out of the stream's own state.
        whole = tables.work_folder()
        rows = tables.stage(rows, whole)
        if not read.get["n"]:
            return None, dict.fromkeys(COUNTS, 0)
        rows = unseen(rows, tables, base)
    annotated = annotate(decode_messages(rows, RAW_SCHEMA))
    reason = F.when(F.col("corrupt"), F.lit(CORRUPT)).otherwise(F.col(REASON))
    annotated = annotated.withColumn(REASON, reason).withColumn("batch_id", F.lit(batch_id).cast("long"))
    refused = F.col(REASON).isNotNull()
    counted = annotated.observe(kept, F.count_if(~refused).alias("accepted"), F.count_if(refused).alias("rejected"))
    # Of a line either its text or its typed values are read again.
    staged = tables.stage(
        counted.select(
            *[F.when(refused, F.col(c)).alias(c) for c in (*ORDER_COLUMNS, "key", "value")],
            *[F.when(~refused, F.col(f"v_{c}")).alias(f"v_{c}") for c in ORDER_COLUMNS],
            *[c for c in (REASON, "message_id", "batch_id", "id", "bucket") if c in counted.columns],
        )
    )
    if dedup:
        tables.drop_stage(whole)
    n, accepted, rejected = read.get["n"], kept.get["accepted"], kept.get["rejected"]
    return staged, dict(zip(COUNTS, (n, n - accepted - rejected, accepted, rejected)))


def _one_row(spark: SparkSession, batch_id: int, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(batch_id, *(counts[c] for c in COUNTS))], BATCHES.schema)


#: Keys of a batch up to which the state before is cut down to them first: few enough to be sent to every task.
FEW_KEYS = 100_000


def _refresh(
    tables: StreamTables, base: Version, state: MartState, lines: DataFrame, batch_id: int
) -> list[tuple[Table, str]]:
    """Write what the batch adds to a mart's state, and the mart rows of the keys it touches.

    Where those are many, all state is merged and the mart's rows are cut down, one for each key: cutting down the state
    would shuffle and sort all its rows once more."""
    keys, made, merged = list(state.mart.keys), [], {}
    touched, few = None, True
    for name, rows in state.added(lines).items():
        table = state_table(state, name, rows)
        made.append((table, tables.write(table, rows)))
        own = tables.segment(*made[-1])
        if touched is None:
            # The first table has one row per key, or per month and order.
            touched = own.select(*keys).distinct() if state.mart.per_order else own.select(*keys)
            few = state.mart.per_order or touched.count() <= FEW_KEYS
        before = tables.read(table, base)
        if state.mart.per_order:
            # Months are few: as literals they prune partitions.
            months = [r[0] for r in touched.collect()]
            before = before.filter(F.col("sales_month").isin(months) if months else F.lit(False))
        elif few:
            before = before.join(touched, keys, "left_semi")
        merged[name] = state.merged(name, own.unionByName(before))
    mart = state.rows(merged)
    if not few:
        mart = mart.join(touched, keys, "left_semi")
    mart = conform(mart, state.name).withColumn("batch_id", F.lit(batch_id).cast("long"))
    table = mart_table(state.name)
    return [*made, (table, tables.write(table, mart))]


def start_ingest(
    messages: DataFrame,
    targets: IngestTargets,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the ingest stream. ``available_now`` drains what is there and stops."""
    if targets.dedup:
        known = messages.withColumn("message_id", identity(messages)).withColumn("id", id_column())
        known = known.withColumn("arrived", F.current_timestamp())
        # The state is kept by the index's 16 bytes, not by an identity's text.
        messages = known.withWatermark("arrived", RECENT).dropDuplicatesWithinWatermark(["id"]).drop("id", "arrived")
    writer = messages.writeStream.foreachBatch(process_batch(targets)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    spark = messages.sparkSession
    own = state_on_disk(spark) if targets.dedup else {}
    if available_now:
        # What the state may forget goes with the next messages, not in a batch of its own before the stream stops.
        own = {**own, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with short_shuffles(spark), settings(spark, own):
        return writer.start()


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All accepted lines of committed batches."""
    return StreamTables(spark, root).read(LANDING).select(*ORDER_COLUMNS)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """All refused messages of committed batches, with their text."""
    return StreamTables(spark, root).read(QUARANTINE)


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Per committed batch: messages read, repeats among them, lines accepted and rejected."""
    return StreamTables(spark, root).read(BATCHES)


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as of the last committed batch."""
    table = mart_table(name)
    return table.merge(StreamTables(spark, root).read(table)).drop("batch_id")


def publish(
    spark: SparkSession, source: str, send: Callable[[DataFrame], None], rejects: str | None = None, multi_line: bool = False
) -> dict[str, int]:
    """Read order lines from CSV, ``send`` the accepted ones as messages and write the refused ones, each with its
    reason, its file and the split it was read in, below ``rejects``. Lines are read once; returns the counts."""
    stage, counts = work_path(spark, "publish"), Observation("publish")
    try:
        annotated = annotate(read_order_rows(spark, source, multi_line))
        refused = F.col(REASON).isNotNull()
        annotated.observe(
            counts, F.count(F.lit(1)).alias("lines"), F.count_if(~refused).alias("accepted"), F.count_if(refused).alias("rejected")
        ).write.parquet(stage)
        staged = spark.read.schema(annotated.schema).parquet(stage)
        # Messages carry the lines as they were written, not as they were understood.
        send(encode_messages(staged.filter(~refused).select(*ORDER_COLUMNS)))
        if rejects:
            rejected(staged).write.mode("append").parquet(rejects)
    finally:
        remove_path(spark, stage)
    log.info("published %s: %s", source, counts.get)
    return dict(counts.get)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="order-line ingest")
    parser.add_argument("--inbox", help="folder of message files")
    parser.add_argument("--kafka", help="bootstrap servers, instead of a folder of message files")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--source", help="order-line CSV to publish")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quoted CSV cells")
    parser.add_argument("--rejects", help="folder for refused lines of the source")
    parser.add_argument("--out", help="folder of the stream's tables and checkpoint")
    parser.add_argument("--files-per-trigger", type=int, default=None)
    parser.add_argument("--offsets-per-trigger", type=int, default=None)
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument("--marts", default=",".join(REVENUE_MARTS), help="marts to keep up to date")
    args = parser.parse_args(argv)
    if bool(args.inbox) == bool(args.kafka):
        parser.error("give either --inbox or --kafka")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session()
    if args.source:
        require_sources(spark, [args.source], "csv")
        if args.kafka:
            send = lambda messages: publish_kafka(messages, args.kafka, args.topic)
        else:
            send = lambda messages: write_message_files(messages, args.inbox)
        publish(spark, args.source, send, args.rejects, args.multi_line)
    if args.out:
        targets = IngestTargets(f"{args.out}/tables", tuple(m for m in args.marts.split(",") if m), args.dedup)
        if args.kafka:
            stream = read_kafka(spark, args.kafka, args.topic, max_offsets_per_trigger=args.offsets_per_trigger)
        else:
            stream = message_file_stream(spark, args.inbox, args.files_per_trigger)
        start_ingest(stream, targets, f"{args.out}/checkpoint").awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
