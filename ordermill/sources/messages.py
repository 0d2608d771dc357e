"""Order-line messages: key = order id text, value = JSON object of the whole line,
message_id = identity of the line in its feed.

The identity is given by the producer: a hash of the value and the number of the
occurrence of that value in the feed. Two genuine equal lines are two messages,
and publishing the same feed again gives the same identities, whatever files or
offsets it lands in.

The codec is plain DataFrame expressions, so the same functions serve batch
files, file streams and Kafka (whose ``key``/``value`` columns are binary and
are cast to text first; message_id travels as a header).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.parse import once
from ..schema import ORDER_COLUMNS

MESSAGE_SCHEMA = StructType([StructField(c, StringType(), True) for c in ("key", "value", "message_id")])
# Default topic name of the order feed (fixed value).
DEFAULT_TOPIC = "ecommerce.orders"


def encode_messages(lines: DataFrame, key: str = "order_id") -> DataFrame:
    """(key, value, message_id) per line; NULL fields stay in the JSON as ``null``.

    Equal lines are counted (map-side combined) and then numbered, so a line that
    fills a third of the feed is no burden. They are sent as columns, which are equal
    where their texts are; the text of a line is made where its copies are numbered.
    """
    body = F.to_json(F.struct(*ORDER_COLUMNS), {"ignoreNullFields": "false"})
    # Floats of one value may have two texts (0.0 and -0.0).
    if any(kind in ("float", "double") for _, kind in lines.select(*ORDER_COLUMNS, key).dtypes):
        counted = lines.select(F.col(key).cast("string").alias("key"), body.alias("value"))
        counted = counted.groupBy("key", "value").agg(F.count(F.lit(1)).alias("copies"))
    else:
        columns = list(dict.fromkeys([*ORDER_COLUMNS, key]))
        counted = lines.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
        counted = once(counted, value=body).select(F.col(key).cast("string").alias("key"), "value", "copies")
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("number")
    return counted.select("key", "value", number).select(
        "key", "value", F.concat(F.sha2("value", 256), F.lit("-"), F.col("number").cast("string")).alias("message_id")
    )


def one_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else.

    The parser reads one value and looks no further, so the text is checked inside
    an array, which it must fill as its only element, and inside an object, as its
    only value: what follows a first object cannot go on in both ways.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    # A text without a bracket can't close the array, so the array alone tells and the text is parsed once less.
    only = ~F.contains(text, F.lit("]")) | (F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1)
    return F.coalesce(F.ltrim(text).startswith("{") & alone & only, F.lit(False))


def identity(messages: DataFrame) -> Column:
    """The message's own identity, or the hash of its value if it has none."""
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    given = F.col("message_id") if "message_id" in messages.columns else F.lit(None).cast("string")
    return F.coalesce(given, F.sha2(text, 256)).alias("message_id")


def decode_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """Parse ``value`` with ``schema``; adds ``corrupt`` (value is not one JSON object, or has anything beside it;
    its fields are then null). Key, value and all other columns are kept. A message without an identity gets the
    hash of its value."""
    text = F.col("value").cast("string")
    extra = [c for c in messages.columns if c not in ("key", "value", "message_id")]
    checked = once(messages, corrupt=~one_object(text))
    whole = once(checked, parsed=F.when(~F.col("corrupt"), F.from_json(text, schema)))
    return whole.select(
        F.col("key").cast("string").alias("key"),
        text.alias("value"),
        *[F.col("parsed").getField(f.name).alias(f.name) for f in schema.fields],
        "corrupt",
        identity(messages),
        *extra,
    )


def kafka_reader_options(bootstrap: str, topic: str = DEFAULT_TOPIC, max_offsets_per_trigger: int | None = None,
                         starting_offsets: str = "earliest") -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets, "includeHeaders": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_writer_options(bootstrap: str, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def read_kafka(spark: SparkSession, bootstrap: str, topic: str = DEFAULT_TOPIC, **kw) -> DataFrame:
    """Streaming (key, value, message_id) text from a topic. Needs the Spark Kafka connector on the classpath."""
    stream = spark.readStream.format("kafka").options(**kafka_reader_options(bootstrap, topic, **kw)).load()
    given = F.filter("headers", lambda h: h["key"] == "message_id")
    return stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.get(given, 0)["value"].cast("string").alias("message_id"),
    )


def kafka_rows(messages: DataFrame) -> DataFrame:
    """Messages as the Kafka sink wants them, message_id as a header."""
    header = F.struct(F.lit("message_id").alias("key"), F.col("message_id").cast("binary").alias("value"))
    return messages.select("key", "value", F.array(header).alias("headers"))


def publish_kafka(messages: DataFrame, bootstrap: str, topic: str = DEFAULT_TOPIC) -> None:
    """Batch publish; each partition writes its own rows. Needs the Kafka connector."""
    kafka_rows(messages).write.format("kafka").options(**kafka_writer_options(bootstrap, topic)).save()
