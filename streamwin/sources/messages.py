"""Events as Kafka messages: source and sink options, decoding and encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.columns import cast_or_null
from ..schema import SHORT_MESSAGE_SCHEMA, TEXT_MESSAGE_SCHEMA
from .files import TIMESTAMP_FORMAT

# Broker and topic used when none are named.
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_TOPIC = "market-events"


def kafka_source_options(
    servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_TOPIC,
    *,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool | None = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka stream source.

    ``min_partitions`` splits large topic partitions over more tasks;
    ``max_offsets_per_trigger`` bounds a micro-batch. ``None`` leaves an option
    to the connector's default.
    """
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": None if fail_on_data_loss is None else str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    return {name: str(value) for name, value in chosen.items() if value is not None}


def stream_kafka(spark: SparkSession, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, **options) -> DataFrame:
    """Raw messages of a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **options)).load()


def decode(
    messages: DataFrame,
    schema: T.StructType = TEXT_MESSAGE_SCHEMA,
    *,
    value: str = "value",
    casts: dict[str, str] | None = None,
) -> DataFrame:
    """Binary JSON messages to flat, typed columns.

    A message that is not JSON, or a field of the wrong type, gives nulls.
    ``casts`` converts fields that arrive as text.

    The struct is spread by a generator. Spark moves filters on the fields of a
    plain ``data.*`` below the parsing, for instance the one for missing event
    times, and would then parse each message again for every such filter.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return cast_or_null(messages.select(F.inline(F.array(parsed))), casts or {})


def decode_text_messages(messages: DataFrame) -> DataFrame:
    """Messages whose price and volume are text; the price becomes a double."""
    return decode(messages, TEXT_MESSAGE_SCHEMA, casts={"price": "double"})


def stream_short_messages(
    spark: SparkSession, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, starting_offsets: str = "latest"
) -> DataFrame:
    """The four-field view of a topic, from its latest messages on."""
    raw = stream_kafka(spark, servers, topic, starting_offsets=starting_offsets, fail_on_data_loss=None)
    return decode(raw, SHORT_MESSAGE_SCHEMA)


def encode(events: DataFrame, key: Column | None = None) -> DataFrame:
    """Each row as one UTF-8 JSON message, without a key unless one is given."""
    body = F.to_json(F.struct("*"), {"timestampFormat": TIMESTAMP_FORMAT}).cast("binary").alias("value")
    return events.select(body) if key is None else events.select(key.cast("binary").alias("key"), body)


def kafka_sink_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(messages: DataFrame, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC) -> None:
    """Send a batch of encoded messages."""
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


def kafka_writer(messages: DataFrame, servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC) -> DataStreamWriter:
    """An unstarted writer that sends a stream of encoded messages."""
    return messages.writeStream.format("kafka").options(**kafka_sink_options(servers, topic))
