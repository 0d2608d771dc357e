"""Streaming ingest equals batch work; no genuine line is lost; replays add nothing; a batch is visible whole or not
at all; the files that readers open stay few."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordermill.operators import validate
from ordermill.operators.clean import clean_orders
from ordermill.operators.marts import REVENUE_MARTS, build
from ordermill.plans import registry
from ordermill.schema import ORDER_COLUMNS, RAW_SCHEMA
from ordermill.session import SHUFFLE_CLEANUP, STATE_PROVIDER, folders, short_shuffles
from ordermill.sources import files, messages
from ordermill.sources.contracts import conform
from ordermill.streaming import commits, ingest
from ordermill.streaming.commits import StreamTables

from .conftest import FIXTURES

ALL = tuple(REVENUE_MARTS)


def _feed(spark):
    """Nine good lines, one of them twice, and two without a quantity."""
    text = files.read_order_text(spark, os.path.join(FIXTURES, "shop_lines.csv"))
    again = text.filter("order_id = '504'")
    broken = text.filter("order_id = '505' or order_id = '507'").withColumn("quantity", F.lit(""))
    return text.unionByName(again).unionByName(broken)


def _messages(spark):
    corrupt = spark.createDataFrame([("9", "not json", "c-1"), ("9", '{"order_id": "1', "c-2")], messages.MESSAGE_SCHEMA)
    return messages.encode_messages(_feed(spark)).unionByName(corrupt)


def _drain(spark, root, targets):
    q = ingest.start_ingest(ingest.message_file_stream(spark, f"{root}/inbox", 3), targets, f"{root}/chk")
    q.awaitTermination()
    assert q.exception() is None


def _run(spark, root, replays=1, dedup=False, feed=None, marts=("monthly_sales",)):
    targets = ingest.IngestTargets(f"{root}/tables", marts, dedup)
    for _ in range(replays):
        ingest.write_message_files(feed if feed is not None else _messages(spark), f"{root}/inbox")
        _drain(spark, root, targets)
    return targets.root


def same(x, y):
    return x.count() == y.count() and x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def check_marts(spark, root, accepted, marts):
    for name in marts:
        want = conform(build(clean_orders(accepted), REVENUE_MARTS[name]), name)
        assert same(ingest.read_mart(spark, root, name), want), name


@pytest.mark.parametrize("replays,dedup", [(1, False), (1, True), (2, True)])
def test_stream_equals_batch(spark, scratch, replays, dedup):
    root = _run(spark, scratch, replays, dedup)
    accepted, rejected = validate.validate(_feed(spark))
    assert same(ingest.read_landed(spark, root), accepted.select(*ORDER_COLUMNS))
    refused = ingest.read_quarantine(spark, root)
    assert refused.count() == rejected.count() + 2 == 4
    corrupt = refused.filter(F.col(validate.REASON) == ingest.CORRUPT).select("message_key", "message_value").collect()
    assert sorted(map(tuple, corrupt)) == [("9", "not json"), ("9", '{"order_id": "1')]
    check_marts(spark, root, accepted, ["monthly_sales"])
    counts = ingest.read_batches(spark, root).agg(*[F.sum(c).alias(c) for c in ingest.COUNTS]).first()
    assert (counts.accepted_lines, counts.rejected_lines) == (10, 4)


def test_all_marts_follow_the_batches(spark, scratch):
    """Lines of one order, product and customer in different batches; a month touched again."""
    step = ingest.process_batch(ingest.IngestTargets(scratch, ALL))
    feed = messages.encode_messages(_feed(spark)).collect()
    for n in range(3):
        step(spark.createDataFrame(feed[n::3], messages.MESSAGE_SCHEMA), n)
    check_marts(spark, scratch, validate.validate(_feed(spark))[0], ALL)


def test_a_feed_in_parts_leaves_only_the_streams_tables(spark, scratch, monkeypatch):
    """Twelve orders of two equal lines each in three parts, replayed: equal lines stay two, the replay adds no
    segments, and neither waiting lines nor message files are kept."""
    date = "timestamp'2025-01-05 10:00:00'"
    orders = f"id o_orderkey, 1L + id % 2 o_custkey, 'O' o_orderstatus, {date} o_orderdate"
    tables = {
        "part": spark.range(1, 4).selectExpr("id p_partkey", "'p' p_name", "'a' p_type", "'d' p_brand", "2.5D p_retailprice"),
        "orders": spark.range(1, 13).selectExpr(*orders.split(", ")),
        "lineitem": spark.range(2, 26).selectExpr("id div 2 l_orderkey", "1 + (id div 2) % 3 l_partkey", "3.0D l_quantity"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{scratch}/{name}.parquet")
    monkeypatch.setattr(registry, "_feed_parts", lambda *a: 3)
    root = registry._run_stream(spark, scratch, replays=2, dedup=True)
    landed = ingest.read_landed(spark, root).groupBy("order_id").count().collect()
    assert sorted(map(tuple, landed)) == [(n, 2) for n in range(1, 13)]
    counts = ingest.read_batches(spark, root).orderBy("batch_id").select("accepted_lines").collect()
    filled = sum(r[0] > 0 for r in counts)
    assert sum(r[0] for r in counts) == 24 and filled <= 3 < 6 <= len(counts)
    live = StreamTables(spark, root).live()
    assert len(live.of("landing")) == len(live.of("ids")) == filled
    stream = root.removesuffix("/tables")
    assert "inbox" not in folders(spark, stream) and not folders(spark, f"{stream}/lines")


def test_shuffle_files_go_with_their_query(spark, scratch):
    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = spark.conf.get(SHUFFLE_CLEANUP)
    known = shuffled()
    with short_shuffles(spark):
        spark.range(1000).repartition(3).write.parquet(f"{scratch}/rows")
    assert not shuffled() - known
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_identity_survives_another_publication(spark):
    first = messages.encode_messages(_feed(spark)).select("message_id")
    second = messages.encode_messages(_feed(spark).repartition(7)).select("message_id")
    assert first.distinct().count() == 12
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_a_committed_batch_is_not_run_again(spark, scratch):
    step = ingest.process_batch(ingest.IngestTargets(scratch, ("monthly_sales",), dedup=True))
    step(_messages(spark), 0)
    step(_messages(spark), 0)  # the same batch id again: committed, but not known to the checkpoint
    step(_messages(spark), 1)  # a replay
    assert ingest.read_landed(spark, scratch).count() == 10
    assert ingest.read_quarantine(spark, scratch).count() == 4
    assert ingest.read_mart(spark, scratch, "monthly_sales").agg(F.sum("item_count")).first()[0] == 28
    counts = [tuple(r) for r in ingest.read_batches(spark, scratch).orderBy("batch_id").collect()]
    assert counts == [(0, 14, 0, 10, 4), (1, 14, 14, 0, 0)]


def test_state_of_many_keys_is_not_cut_down_before_it_is_merged(spark, scratch, monkeypatch):
    """Its rows go through one exchange by key, and what comes out of an aggregation is written from there; keys that a
    batch doesn't touch get no new mart row."""
    dealt, plans, write = [], [], StreamTables.write

    def watched(self, table, rows):
        if table.name in ALL:
            plans.append((table.name, rows._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi")))
        return write(self, table, rows)

    rebalanced = commits.by_partition
    monkeypatch.setattr(commits, "by_partition", lambda rows, *by: (dealt.append(rows.columns), rebalanced(rows, *by))[1])
    monkeypatch.setattr(StreamTables, "write", watched)
    monkeypatch.setattr(ingest, "FEW_KEYS", 1, raising=False)
    marts = ("top_products", "customer_metrics", "ml_customer_features")
    step = ingest.process_batch(ingest.IngestTargets(scratch, marts))
    feed = messages.encode_messages(_feed(spark)).collect()
    for n in range(3):
        step(spark.createDataFrame(feed[n::3], messages.MESSAGE_SCHEMA), n)
    assert dict(plans) == dict.fromkeys(marts, 1)
    assert not [columns for columns in dealt if "measure" in columns]
    check_marts(spark, scratch, validate.validate(_feed(spark))[0], marts)
    made = StreamTables(spark, scratch).read(ingest.mart_table("customer_metrics")).groupBy("batch_id").count().collect()
    own = [{messages_of["key"] for messages_of in feed[n::3]} for n in range(3)]
    assert all(r["count"] <= len(own[r.batch_id]) for r in made)


@pytest.mark.parametrize("lost", ["landing", "customer_metrics_sets", "commit"])
def test_a_crash_leaves_readers_on_the_batch_before(spark, scratch, monkeypatch, lost):
    marts = ("customer_metrics",)
    step = ingest.process_batch(ingest.IngestTargets(scratch, marts, dedup=True))
    rows = _messages(spark).collect()
    frames = [spark.createDataFrame(part, messages.MESSAGE_SCHEMA) for part in (rows[:7], rows[7:])]
    step(frames[0], 0)

    def visible():
        read = [ingest.read_landed, ingest.read_quarantine, ingest.read_batches]
        out = [sorted(map(str, f(spark, scratch).collect())) for f in read]
        return out + [sorted(map(str, ingest.read_mart(spark, scratch, m).collect())) for m in marts]

    before, write = visible(), StreamTables.write

    def broken(self, table, rows):
        segment = write(self, table, rows)
        if table.name == lost:
            raise OSError("lost")
        return segment

    if lost == "commit":
        monkeypatch.setattr(StreamTables, "_merged", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    else:
        monkeypatch.setattr(StreamTables, "write", broken)
    with pytest.raises(OSError):
        step(frames[1], 1)
    assert visible() == before
    monkeypatch.undo()
    step(frames[1], 1)
    assert ingest.read_landed(spark, scratch).count() == 10
    accepted, _ = validate.validate(_feed(spark))
    check_marts(spark, scratch, accepted, marts)
    # What the crash left is gone, and so is the staged batch.
    live = StreamTables(spark, scratch).live()
    for name in folders(spark, scratch):
        if name != commits.LOG:
            assert len(folders(spark, f"{scratch}/{name}")) == len(live.of(name)), name


def test_few_files_after_many_batches(spark, scratch, monkeypatch):
    monkeypatch.setattr(commits, "FANOUT", 3)
    step = ingest.process_batch(ingest.IngestTargets(scratch, ("top_products",), dedup=True))
    line = files.read_order_text(spark, os.path.join(FIXTURES, "shop_lines.csv")).filter("order_id = '504'").first()
    most = 0
    for n in range(10):
        text = spark.createDataFrame([{**line.asDict(), "order_id": str(n), "order_date": "2025-01-03"}], RAW_SCHEMA)
        step(messages.encode_messages(text), n)
        if n in (6, 9):
            landed = ingest.read_landed(spark, scratch)
            most = max(most, len(landed.inputFiles()))
            assert sorted(r.order_id for r in landed.collect()) == list(range(n + 1))
    # At most FANOUT - 1 segments of each level, with a file per month.
    assert most <= 6
    live = StreamTables(spark, scratch).live()
    assert all(len(live.of(t)) <= 6 for t in ("landing", "ids", "top_products", "top_products_sums", "top_products_sets"))
    assert len(folders(spark, f"{scratch}/commits")) == commits.KEPT
    mart = ingest.read_mart(spark, scratch, "top_products").first()
    assert (mart.order_count, mart.total_quantity) == (10, 10 * int(line.quantity))
    step(messages.encode_messages(text), 10)  # an old message after merges
    assert ingest.read_landed(spark, scratch).count() == 10


def test_the_index_is_read_in_the_buckets_that_are_hit(spark, scratch):
    step = ingest.process_batch(ingest.IngestTargets(scratch, dedup=True))
    many = spark.range(400).select(F.lit("1").alias("key"), F.lit("{}").alias("value"), F.col("id").cast("string").alias("message_id"))
    step(many, 0)
    tables = StreamTables(spark, scratch)
    version = tables.live()
    few = many.filter("message_id in ('3', '77')")
    hit = {r.bucket for r in ingest.with_bucket(few.withColumn("id", ingest.id_column())).collect()}
    index = ingest.indexed(tables, version, sorted(hit))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {int(f.split("bucket=")[1].split("/")[0]) for f in index.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert read == hit and len(hit) < ingest.ID_BUCKETS
    assert ingest.unseen(few, tables, version).count() == 0


def test_replay_across_restarts(spark, scratch):
    """The state of the stream is lost with its checkpoint; the index is not."""
    targets = ingest.IngestTargets(f"{scratch}/tables", (), dedup=True)
    for _ in range(2):
        ingest.write_message_files(_messages(spark), f"{scratch}/inbox")
        _drain(spark, scratch, targets)
    step = ingest.process_batch(targets)
    step(_messages(spark), 99)
    assert ingest.read_landed(spark, targets.root).count() == 10
    assert ingest.read_quarantine(spark, targets.root).count() == 4


def test_every_line_rejected(spark, scratch):
    feed = messages.encode_messages(_feed(spark).withColumn("quantity", F.lit("none")))
    root = _run(spark, scratch, feed=feed, marts=ALL)
    assert ingest.read_landed(spark, root).count() == 0
    assert ingest.read_quarantine(spark, root).count() == 12
    assert all(ingest.read_mart(spark, root, m).count() == 0 for m in ALL)


def test_a_streams_own_state_is_kept_in_files(spark, scratch):
    """Not as objects on the heap; the session's own setting is as it was, and a provider that it names stays."""
    before = spark.conf.get(STATE_PROVIDER)
    for kind, ends in ((None, ".zip"), (before, ".delta")):
        root = f"{scratch}/{ends[1:]}"
        if kind:
            spark.conf.set(STATE_PROVIDER, kind)
        _run(spark, root, replays=2, dedup=True, marts=())
        kept = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/chk/state/0/0/")
        names = [r.path for r in kept.select("path").collect()]
        assert any(n.endswith(ends) for n in names), names
        assert ingest.read_landed(spark, f"{root}/tables").count() == 10
        assert spark.conf.get(STATE_PROVIDER) == before
    spark.conf.unset(STATE_PROVIDER)


def test_few_landing_files_of_a_stream_with_state(spark, scratch):
    root = _run(spark, scratch, dedup=True, marts=())
    landed = ingest.read_landed(spark, root)
    months = landed.select(F.trunc("order_date", "month")).distinct().count()
    assert len(landed.inputFiles()) <= months
    ids = StreamTables(spark, root).read(ingest.IDS)
    assert len(ids.inputFiles()) <= ids.select("bucket").distinct().count()


def test_few_landing_files(spark, scratch):
    ingest.process_batch(ingest.IngestTargets(scratch))(_messages(spark).repartition(16), 0)
    assert len(ingest.read_landed(spark, scratch).inputFiles()) <= 3


def test_nothing_to_read_before_the_first_batch(spark, scratch):
    assert ingest.read_landed(spark, scratch).count() == ingest.read_quarantine(spark, scratch).count() == 0
    assert ingest.read_mart(spark, scratch, "top_products").count() == 0


@pytest.mark.parametrize(
    "text,corrupt",
    [
        ('{"order_id": "1"}', False), (' {"order_id": "1", "aisle": "]}"}\n', False), ("{}", False),
        ('{"order_id": "1"} trailing', True), ('{"order_id": "1"}{"order_id": "2"}', True),
        ('{"order_id": "1"},{"order_id": "2"}', True), ('{"order_id": "1"} {"order_id": "2"}', True),
        ('{"order_id": "1"}] x', True), ('{"order_id": "1"}} x', True), ('{"order_id": "1"}}', True),
        ('{"order_id": "1"},"b": 2', True), ('{"order_id": "1"', True), ('[{"order_id": "1"}]', True), ('"x"', True),
        ("", True), (None, True),
    ],
)
def test_messages_hold_one_object(spark, text, corrupt):
    rows = spark.createDataFrame([("k", text, "m")], messages.MESSAGE_SCHEMA)
    got = messages.decode_messages(rows, RAW_SCHEMA).first()
    assert got.corrupt is corrupt and got.value == text
    assert got.order_id == (None if corrupt or text == "{}" else "1")


@pytest.fixture
def command(spark, monkeypatch):
    monkeypatch.setattr(ingest, "build_session", lambda: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    return ingest.main


def test_publish_and_ingest_from_the_command_line(spark, scratch, command):
    """Refused lines stay behind, with their reason, file and split."""
    text = files.read_order_text(spark, os.path.join(FIXTURES, "shop_lines.csv"))
    broken = text.filter("order_id = '505'").withColumn("quantity", F.lit("none"))
    files.write_csv(text.unionByName(broken).coalesce(1), f"{scratch}/csv")
    command(["--inbox", f"{scratch}/in", "--source", f"{scratch}/csv", "--rejects", f"{scratch}/rejects"])
    command(["--inbox", f"{scratch}/in", "--out", f"{scratch}/out", "--dedup", "--marts", "category_performance"])
    assert ingest.read_landed(spark, f"{scratch}/out/tables").count() == 9
    assert ingest.read_mart(spark, f"{scratch}/out/tables", "category_performance").count() == 3
    left = spark.read.parquet(f"{scratch}/rejects").collect()
    assert [(r.order_id, r.reject_reason, r.source_block) for r in left] == [("505", "invalid_numeric", 0)] * len(left)
    assert left and all("/csv/part-" in r.source_file for r in left)
    counts = ingest.publish(spark, f"{scratch}/csv", lambda messages: None)
    assert counts == {"lines": 9 + len(left), "accepted": 9, "rejected": len(left)}


def test_kafka_from_the_command_line(spark, scratch, command, monkeypatch):
    """Up to the connector's options: no broker runs here."""
    sent, read = {}, {}
    monkeypatch.setattr(ingest, "publish_kafka", lambda m, servers, topic: sent.update(n=m.count(), to=(servers, topic)))

    def stream(session, servers, topic, **kw):
        read.update(options=messages.kafka_reader_options(servers, topic, **kw))
        return ingest.message_file_stream(session, f"{scratch}/in")

    monkeypatch.setattr(ingest, "read_kafka", stream)
    source = os.path.join(FIXTURES, "shop_lines.csv")
    ingest.write_message_files(_messages(spark), f"{scratch}/in")
    command(["--kafka", "h:9092", "--topic", "t", "--source", source, "--out", f"{scratch}/out", "--offsets-per-trigger", "7", "--marts", ""])
    assert sent == {"n": 9, "to": ("h:9092", "t")}
    assert read["options"]["maxOffsetsPerTrigger"] == "7" and read["options"]["subscribe"] == "t"
    assert ingest.read_landed(spark, f"{scratch}/out/tables").count() == 10
    with pytest.raises(SystemExit):
        command(["--source", source])
