from .files import events_from_rows, read_events, stream_events, write_events
from .messages import (
    decode,
    decode_text_messages,
    encode,
    kafka_sink_options,
    kafka_source_options,
    kafka_writer,
    stream_kafka,
    stream_short_messages,
    write_kafka,
)
from .metric_files import read_flat_metrics, read_metrics, write_metrics

__all__ = [
    "decode",
    "decode_text_messages",
    "encode",
    "events_from_rows",
    "kafka_sink_options",
    "kafka_source_options",
    "kafka_writer",
    "read_events",
    "read_flat_metrics",
    "read_metrics",
    "stream_events",
    "stream_kafka",
    "stream_short_messages",
    "write_events",
    "write_kafka",
    "write_metrics",
]
