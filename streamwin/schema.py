"""Row layouts of market events, their message encodings and metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of a market event.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("volume", T.LongType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("trade_type", T.StringType(), False),
    ]
)

# The same event as a message whose numbers arrive as text.
TEXT_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("volume", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("trade_type", T.StringType()),
    ]
)

# The four-field message of the helper reader.
SHORT_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.IntegerType()),
    ]
)

# The generic event table the registered queries read.
EVENT_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Metric samples in long form. Numeric metrics fill ``value``; the watermark
# metric carries its delay text in ``label``.
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("window_type", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("label", T.StringType()),
    ]
)


def market_view(events: DataFrame) -> DataFrame:
    """Present a generic ``events`` table as market events.

    ``ts`` is a zone-less timestamp; it is read as UTC, so the session time
    zone has to be UTC. Every column is a projection, so whatever a query does
    not use is pruned from the scan.
    """
    return events.select(
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "purchase", "BUY").otherwise("SELL").alias("trade_type"),
    )
