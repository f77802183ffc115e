"""Registered queries that carry all events through messages and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import cast_or_null
from ..operators import keyed_tumbling
from ..schema import SHORT_MESSAGE_SCHEMA
from ..sources import decode, decode_text_messages, encode, read_events, write_events
from .queries_windows import PAIR_EXACT, events_of, zoneless
from .scratch import scratch_folder
from .sql import EVENTS, PAIR_SQL, tumbling_sql


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode(events_of(spark, folder))


def _text_fields(spark: SparkSession, folder: str) -> DataFrame:
    return zoneless(cast_or_null(decode_text_messages(_messages(spark, folder)), {"volume": "bigint"}))


def _short(spark: SparkSession, folder: str) -> DataFrame:
    return zoneless(decode(_messages(spark, folder), SHORT_MESSAGE_SCHEMA))


def _windows_of_messages(spark: SparkSession, folder: str) -> DataFrame:
    return zoneless(keyed_tumbling(decode_text_messages(_messages(spark, folder)), measures=PAIR_EXACT))


def _json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_folder(spark, "json")
    write_events(events_of(spark, folder), place)
    return zoneless(read_events(spark, place))


def _json_inferred(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_folder(spark, "json")
    write_events(events_of(spark, folder), place)
    return zoneless(read_events(spark, place, schema=None))


_EVENTS_SQL = f"with {EVENTS} select event_time, symbol, price, volume, user_id, trade_type from v"

QUERIES = {
    "messages_text_fields": _text_fields,
    "messages_short": _short,
    "messages_windows": _windows_of_messages,
    "json_round_trip": _json_round_trip,
    "json_inferred": _json_inferred,
}

ORACLES = {
    "messages_text_fields": _EVENTS_SQL,
    "messages_short": f"with {EVENTS} select event_time, symbol, price, cast(volume as integer) as volume from v",
    "messages_windows": tumbling_sql("2 minutes", PAIR_SQL, "symbol"),
    "json_round_trip": _EVENTS_SQL,
    "json_inferred": _EVENTS_SQL,
}
