"""Tumbling, sliding, hybrid and multi-granularity aggregation.

Each function takes a batch or a streaming DataFrame and returns one of the
same kind. On batch input the wide forms first aggregate narrow panes, whose
width divides every window involved, and build the windows from the panes. Rows
are then read and hashed once, whatever the number of windows they fall into,
and only panes are copied and shuffled a second time. A stream keeps Spark's
one-step form, since its output mode and lateness rules belong to the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import tagged, window_bounds
from ..functions.durations import interval_micros, micros_interval
from ..functions.measures import FULL, Measures

# Default widths and watermark delays.
TUMBLING_WIDTH = "5 minutes"
SLIDE = "1 minute"
WINDOW_DELAY = "5 minutes"
GRANULARITIES = ("1 minute", "5 minutes", "15 minutes")

# More panes than this in a window are put together by doubling.
_MANY_PANES = 32

# Fixed value: how Spark marks a column by which a watermark closes state.
_WATERMARK = "spark.watermarkDelayMs"


def tumbling(
    events: DataFrame,
    duration: str = TUMBLING_WIDTH,
    *,
    delay: str = WINDOW_DELAY,
    keys: Sequence[str] = (),
    measures: Measures = FULL,
    event_time: str = "event_time",
) -> DataFrame:
    """One row per ``[start, end)`` window of fixed width (and per key)."""
    if events.isStreaming:
        grouped = events.withWatermark(event_time, delay).groupBy(F.window(event_time, duration), *keys)
        return _layout(grouped.agg(*measures.direct()), keys, measures)
    # A batch groups by the start alone, a shorter key than both bounds.
    start, width = F.window(event_time, duration)["start"].alias("_start"), interval_micros(duration)
    rows = events.groupBy(start, *keys).agg(*measures.direct())
    end = F.timestamp_micros(F.unix_micros("_start") + width)
    return _layout(rows, keys, measures, [F.col("_start").alias("window_start"), end.alias("window_end")])


def sliding(
    events: DataFrame,
    size: str = TUMBLING_WIDTH,
    slide: str = SLIDE,
    *,
    delay: str = WINDOW_DELAY,
    keys: Sequence[str] = (),
    measures: Measures = FULL,
    event_time: str = "event_time",
    panes: bool | None = None,
) -> DataFrame:
    """Overlapping windows: one of width ``size`` starting every ``slide``.

    ``panes`` chooses the form that builds windows from panes; by default batch
    input uses it. If a window has more than 32 panes, they are first put
    together to panes of doubled widths, and a window is made of a few of those.
    """
    return _layout(_sliding(events, size, slide, delay, keys, measures, event_time, panes), keys, measures)


def hybrid(
    events: DataFrame,
    tumbling_duration: str = TUMBLING_WIDTH,
    sliding_duration: str = SLIDE,
    *,
    delay: str = WINDOW_DELAY,
    keys: Sequence[str] = (),
    measures: Measures = FULL,
    event_time: str = "event_time",
    shared: bool | None = None,
) -> DataFrame:
    """Tumbling and sliding windows of the same width, told apart by ``window_type``.

    When the slide divides the width, every tumbling window is also a sliding
    one, so a single sliding aggregation serves both: a stream keeps one state
    store instead of two and a batch reads its input once. ``shared=False``, or
    a slide that does not divide the width, aggregates twice and unites.
    """
    width = interval_micros(tumbling_duration)
    divides = width % interval_micros(sliding_duration) == 0
    if shared and not divides:
        raise ValueError("a shared hybrid needs a slide that divides the window width")
    if shared or (shared is None and divides):
        rows = _sliding(events, tumbling_duration, sliding_duration, delay, keys, measures, event_time, None)
        aligned = F.unix_micros(F.col("window.start")) % width == 0
        kinds = F.when(aligned, F.array(F.lit("tumbling"), F.lit("sliding"))).otherwise(F.array(F.lit("sliding")))
        return _layout(rows, keys, measures, window_type=F.explode(kinds))
    common = dict(delay=delay, keys=keys, measures=measures, event_time=event_time)
    united = tagged(tumbling(events, tumbling_duration, **common), window_type="tumbling").unionByName(
        tagged(sliding(events, tumbling_duration, sliding_duration, **common), window_type="sliding")
    )
    return united.select(*_order(keys, measures, ["window_type"]))


def multi_granularity(
    events: DataFrame,
    granularities: Sequence[str] = GRANULARITIES,
    *,
    delay: str | None = None,
    keys: Sequence[str] = (),
    measures: Measures = FULL,
    event_time: str = "event_time",
    single_scan: bool | None = None,
) -> DataFrame:
    """Tumbling windows of several widths, labelled by ``granularity``.

    ``delay`` defaults to twice the widest granularity. By default the input is
    read once, and a stream keeps one state: an event is copied to its window
    of each width, and the end of that window, on which state is closed and
    lateness judged, is what the copies are grouped by. ``single_scan=False``
    aggregates each granularity on its own, with the same results, and reads
    a stream once for each. ``single_scan=True`` on a stream reports a window
    only when the widest window around it closes, and judges lateness by that
    one; every width then has to divide the widest.
    """
    widths = {text: interval_micros(text) for text in granularities}
    if not widths:
        raise ValueError("at least one granularity is needed")
    if delay is None:
        delay = micros_interval(2 * max(widths.values()))
    if single_scan is False:
        parts = [
            tagged(
                tumbling(events, text, delay=delay, keys=keys, measures=measures, event_time=event_time),
                granularity=text,
            )
            for text in granularities
        ]
        united = reduce(DataFrame.unionByName, parts)
        return united.select(*_order(keys, measures, ["granularity"]))
    if events.isStreaming and single_scan is None:
        return _by_ends(events, widths, delay, keys, measures, event_time)
    if events.isStreaming:
        widest = max(widths.values())
        if any(widest % width for width in widths.values()):
            raise ValueError("on a stream every granularity has to divide the widest one")
        marked = events.withWatermark(event_time, delay)
        copies = marked.withColumn("_slot", F.explode(_slots(F.col(event_time), widths)))
        grouped = copies.groupBy(F.window(event_time, micros_interval(widest)).alias("_outer"), "_slot", *keys)
        rows = grouped.agg(*measures.direct())
    else:
        panes = _panes(events, gcd(*widths.values()), keys, measures, event_time)
        copies = panes.withColumn("_slot", F.explode(_slots(F.col("_pane"), widths)))
        rows = copies.groupBy("_slot", *keys).agg(*measures.merged())
    return _layout(rows, keys, measures, window_bounds("_slot.window"), granularity=F.col("_slot.granularity"))


def static_sliding(
    events: DataFrame,
    window_duration: str = "10 minutes",
    sliding_duration: str = "2 minutes",
    *,
    delay: str = WINDOW_DELAY,
    keys: Sequence[str] = (),
    measures: Measures = FULL,
    event_time: str = "event_time",
) -> DataFrame:
    """Sliding windows under a fixed watermark, with the delay as a column."""
    rows = _sliding(events, window_duration, sliding_duration, delay, keys, measures, event_time, None)
    return _layout(rows, keys, measures, watermark_delay=F.lit(delay))


def _by_ends(events, widths: dict[str, int], delay: str, keys, measures: Measures, event_time: str) -> DataFrame:
    """Windows of several widths in one state of a stream.

    The watermark is that of the events. The column it closes state by is the
    end of a window, marked as Spark itself marks the windows it makes: a query
    may set only one watermark, and that of the ends would run ahead.
    """
    marked = events.withWatermark(event_time, delay).filter(F.col(event_time).isNotNull())
    slots = marked.withColumn("_slot", F.explode(_slots(F.col(event_time), widths)))
    closing = {_WATERMARK: interval_micros(delay) // 1000}
    ends = slots.select(
        "*",
        F.col("_slot.granularity").alias("_width"),
        F.col("_slot.window.start").alias("_start"),
        F.col("_slot.window.end").alias("_end", metadata=closing),
    )
    rows = ends.groupBy("_width", "_start", "_end", *keys).agg(*measures.direct())
    bounds = [F.col("_start").alias("window_start"), F.col("_end").alias("window_end")]
    return _layout(rows, keys, measures, bounds, granularity=F.col("_width"))


def _sliding(events, size, slide, delay, keys, measures, event_time, panes) -> DataFrame:
    """Sliding aggregation that still carries its window struct."""
    if panes is None:
        panes = not events.isStreaming
    if panes and events.isStreaming:
        raise ValueError("the pane form is for batch input")
    width, step = interval_micros(size), interval_micros(slide)
    if panes and step < width:
        pane = gcd(width, step)
        narrow = _panes(events, pane, keys, measures, event_time)
        if width // pane > _MANY_PANES:
            return _from_doubled(narrow, pane, width // pane, step // pane, keys, measures)
        return narrow.groupBy(F.window("_pane", size, slide), *keys).agg(*measures.merged())
    marked = events.withWatermark(event_time, delay)
    return marked.groupBy(F.window(event_time, size, slide), *keys).agg(*measures.direct())


def _panes(events: DataFrame, width: int, keys, measures: Measures, event_time: str) -> DataFrame:
    """Partial measures per narrow time pane (and key)."""
    pane = F.window(event_time, micros_interval(width))["start"].alias("_pane")
    return events.groupBy(pane, *keys).agg(*measures.partial())


def _from_doubled(panes: DataFrame, pane: int, count: int, step: int, keys, measures: Measures) -> DataFrame:
    """Windows of ``count`` panes, one every ``step`` panes, from panes of doubled widths.

    Pane ``at`` of level k spans 2**k narrow ones from ``at * 2**k``. A window
    takes the widest that fit: those it contains but whose doubled pane it does
    not contain, two of each level at most. So a pane of level k goes to at
    most 2**k windows, and a narrow one with all its doublings to some
    ``log2(count)`` each rather than to ``count / step``.
    """
    top = count.bit_length() - 1
    number = F.floor(F.unix_micros("_pane") / pane).cast("bigint")
    levels = panes.select("*", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_level"), number.alias("_number"))
    wide = levels.groupBy("_level", F.expr("shiftright(_number, _level)").alias("_at"), *keys).agg(*measures.combined())
    width = F.expr("shiftleft(1L, _level)")
    start = F.col("_at") * width
    even = F.pmod("_at", F.lit(2)) == 0
    contained = start + width - count
    first = F.when(even, contained).otherwise(F.greatest(start - width + 1, contained))
    # The top level has no doubled panes that fit.
    last = F.when(even & (F.col("_level") < top), F.least(start, start + 2 * width - count - 1)).otherwise(start)
    first = F.when(~even & (F.col("_level") == top), contained).otherwise(first)
    begin = F.ceil(first / step).cast("bigint") * step
    fitting = F.when(begin <= last, F.sequence(begin, last, F.lit(step).cast("bigint")))
    rows = wide.select("*", F.explode(fitting).alias("_first")).groupBy("_first", *keys).agg(*measures.merged())
    bounds = [F.timestamp_micros(F.col("_first") * pane), F.timestamp_micros((F.col("_first") + count) * pane)]
    return rows.withColumn("window", F.struct(bounds[0].alias("start"), bounds[1].alias("end")))


def _slots(at: Column, widths: dict[str, int]) -> Column:
    """The window of each granularity that ``at`` falls into, as an array of structs."""
    micros = F.unix_micros(at)

    def slot(text: str, width: int) -> Column:
        start = micros - F.pmod(micros, F.lit(width))
        window = F.struct(
            F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + width).alias("end")
        )
        return F.struct(F.lit(text).alias("granularity"), window.alias("window"))

    return F.array(*[slot(text, width) for text, width in widths.items()])


def _order(keys, measures: Measures, tags: Sequence[str] = ()) -> list[str]:
    """Column order: keyed rows lead with their bounds and keys, others end with the bounds."""
    bounds = ["window_start", "window_end"]
    if keys:
        return [*bounds, *keys, *measures.names, *tags]
    return [*measures.names, *tags, *bounds]


def _layout(
    rows: DataFrame, keys, measures: Measures, bounds: list[Column] | None = None, **tags: Column
) -> DataFrame:
    """Put the window's bounds, the keys, the measures and the tags in their order."""
    made = dict(zip(("window_start", "window_end"), bounds or window_bounds()))
    made |= {name: tag.alias(name) for name, tag in tags.items()}
    return rows.select(*[made.get(name, name) for name in _order(keys, measures, list(tags))])
