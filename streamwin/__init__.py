"""Time-window analytics over event tables and event streams, on PySpark DataFrames."""

from . import functions, operators, plans, sources, streaming
from .schema import EVENT_SCHEMA, METRIC_SCHEMA, SHORT_MESSAGE_SCHEMA, TEXT_MESSAGE_SCHEMA, market_view

__all__ = [
    "EVENT_SCHEMA",
    "METRIC_SCHEMA",
    "SHORT_MESSAGE_SCHEMA",
    "TEXT_MESSAGE_SCHEMA",
    "functions",
    "market_view",
    "operators",
    "plans",
    "sources",
    "streaming",
]
