"""Event files: JSON lines in batch and as a stream, other formats by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import parse_event_time
from ..schema import EVENT_SCHEMA

# Writes microseconds and the offset, so reading back gives the same instant.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def events_from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """A few rows held by the caller, as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def read_events(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = EVENT_SCHEMA, event_time: str = "event_time"
) -> DataFrame:
    """Read JSON-lines events. ``schema=None`` infers it, at the price of one more pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return parse_event_time(reader.json(path), event_time)


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENT_SCHEMA,
    *,
    file_format: str = "json",
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Follow a directory of event files; ``max_files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def write_events(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write events as JSON lines that :func:`read_events` reads back unchanged."""
    events.write.mode(mode).option("timestampFormat", TIMESTAMP_FORMAT).json(path)
