"""Session windows: activity of a key, closed after a gap without events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import window_bounds
from ..functions.durations import interval_micros
from ..functions.measures import FULL, Measures

# Default gap and watermark delay.
SESSION_GAP = "30 minutes"
SESSION_DELAY = "10 minutes"


def session(
    events: DataFrame,
    gap: str | Column = SESSION_GAP,
    *,
    delay: str = SESSION_DELAY,
    keys: Sequence[str] = ("user_id",),
    measures: Measures = FULL,
    event_time: str = "event_time",
    cells: bool | None = None,
) -> DataFrame:
    """One row per key and session, ending ``gap`` after its last event.

    Events exactly one gap apart share a session. ``gap`` may be a column that
    gives each event its own timeout; an event whose timeout is null, zero or
    negative is left out.

    Batch input is first aggregated into cells one gap wide. Two events of a
    cell are closer than the gap, so they belong to one session for certain,
    and merging cells gives the same sessions as merging events. Cells combine
    before the shuffle and spread a busy key over all tasks; what then meets on
    the key is bounded by the time covered, not by the number of events. With a
    timeout per event, events are parted by the power of two below their
    timeout, which is also the width of their cells: at most four cells for
    each smallest timeout covered, whatever the timeouts. ``cells=False``
    merges the events themselves, which saves a shuffle where nearly every
    session is a single event. A stream always does so, and its output mode has
    to be append or complete.
    """
    if cells is None:
        cells = not events.isStreaming
    if cells and events.isStreaming:
        raise ValueError("cells need batch input")
    if cells:
        rows = _merge_cells(events, gap, keys, measures, event_time)
    else:
        marked = events.withWatermark(event_time, delay)
        span = F.session_window(event_time, gap)
        rows = marked.groupBy(span.alias("window"), *keys).agg(*measures.direct())
    return rows.select(*keys, *window_bounds("window", "session_start", "session_end"), *measures.names)


def _merge_cells(events: DataFrame, gap: str | Column, keys, measures: Measures, event_time: str) -> DataFrame:
    micros = F.unix_micros(event_time)
    if isinstance(gap, str):
        cell = [F.window(event_time, gap)["start"].alias("_cell")]
        timeout = F.lit(interval_micros(gap))
    else:
        # Spark's own session of a single event tells how long that event lasts.
        alone = events.withColumn("_alone", F.session_window(event_time, gap))
        lasting = F.unix_micros("_alone.end") - F.unix_micros("_alone.start")
        events = alone.withColumn("_timeout", lasting).drop("_alone")
        timeout = F.col("_timeout")
        # Cells as wide as the power of two below the timeout: two events of one
        # are closer than either lasts.
        power = (F.length(F.bin(timeout)) - 1).cast("int")
        cell = [power.alias("_power"), F.call_function("shiftright", micros, power).alias("_cell")]
    cells = events.groupBy(*cell, *keys).agg(
        F.min(event_time).alias("_first"), F.max(micros + timeout).alias("_until"), *measures.partial()
    )
    open_micros = F.col("_until") - F.unix_micros("_first")
    open_for = F.make_interval(secs=open_micros.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)"))
    return cells.groupBy(F.session_window("_first", open_for).alias("window"), *keys).agg(*measures.merged())
