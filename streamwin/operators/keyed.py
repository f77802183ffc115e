"""Per-symbol strategies: event count and mean price of every symbol in a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..functions.measures import COUNT_AND_AVERAGE, Measures
from . import sessions, windows

# Default widths, gap and watermark delay of the per-symbol strategies.
KEYED_WIDTH = "2 minutes"
KEYED_SLIDE = "1 minute"
KEYED_GAP = "2 minutes"
KEYED_DELAY = "5 minutes"


def keyed_tumbling(
    events: DataFrame,
    duration: str = KEYED_WIDTH,
    *,
    delay: str = KEYED_DELAY,
    keys: Sequence[str] = ("symbol",),
    measures: Measures = COUNT_AND_AVERAGE,
    event_time: str = "event_time",
) -> DataFrame:
    return windows.tumbling(events, duration, delay=delay, keys=keys, measures=measures, event_time=event_time)


def keyed_sliding(
    events: DataFrame,
    size: str = KEYED_WIDTH,
    slide: str = KEYED_SLIDE,
    *,
    delay: str = KEYED_DELAY,
    keys: Sequence[str] = ("symbol",),
    measures: Measures = COUNT_AND_AVERAGE,
    event_time: str = "event_time",
) -> DataFrame:
    return windows.sliding(events, size, slide, delay=delay, keys=keys, measures=measures, event_time=event_time)


def keyed_multi_granularity(
    events: DataFrame,
    granularities: Sequence[str] = windows.GRANULARITIES,
    *,
    delay: str = KEYED_DELAY,
    keys: Sequence[str] = ("symbol",),
    measures: Measures = COUNT_AND_AVERAGE,
    event_time: str = "event_time",
    single_scan: bool | None = None,
) -> DataFrame:
    return windows.multi_granularity(
        events,
        granularities,
        delay=delay,
        keys=keys,
        measures=measures,
        event_time=event_time,
        single_scan=single_scan,
    )


def keyed_session(
    events: DataFrame,
    gap: str | Column = KEYED_GAP,
    *,
    delay: str = KEYED_DELAY,
    keys: Sequence[str] = ("symbol",),
    measures: Measures = COUNT_AND_AVERAGE,
    event_time: str = "event_time",
    cells: bool | None = None,
) -> DataFrame:
    """Sessions per symbol, with the bounds named and placed as in the other strategies."""
    rows = sessions.session(
        events, gap, delay=delay, keys=keys, measures=measures, event_time=event_time, cells=cells
    )
    renamed = rows.withColumnsRenamed({"session_start": "window_start", "session_end": "window_end"})
    return renamed.select("window_start", "window_end", *keys, *measures.names)
