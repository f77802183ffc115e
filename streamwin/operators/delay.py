"""Lateness statistics and the watermark delay estimated from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import arrival_delay, with_event_time
from ..functions.durations import bound_minutes
from ..functions.measures import FULL, Measures
from .windows import static_sliding

# Percentile, safety factor, delay assumed without statistics, default bounds.
PERCENTILE = 0.95
SAFETY_FACTOR = 1.2
ASSUMED_DELAY_SECONDS = 300
MAX_DELAY = "30 minutes"
MIN_DELAY = "1 minute"

# The recorded formula divides whole seconds as if they were milliseconds.
_COMPAT_UNITS_PER_MINUTE = 60_000
_COMPAT_ASSUMED = 300_000

_BUCKET_SECONDS = 86_400


def delay_stats(
    events: DataFrame,
    *,
    as_of: Column | str | None = None,
    event_time: str = "event_time",
    approximate: bool = False,
    accuracy: int = 10_000,
    suffix: str = "s",
) -> DataFrame:
    """Maximum, mean and 95th percentile of the arrival delay, in seconds, as one row.

    Rows without an event time are left out; without any row the statistics
    are null. ``suffix="ms"`` gives the columns their historical names; the
    values stay seconds.

    The exact percentile is found in two narrow passes over the event time:
    counts per day of delay tell which days hold the ranks wanted, and only the
    rows of those (at most two) days are then counted per second. What meets in
    one task is one row per day of delay, then 86,400 seconds at most, however
    many events there are. ``approximate`` uses a sketch in a single pass.
    """
    names = [f"{part}_delay_{suffix}" for part in ("max", "avg", "p95")]
    delays = with_event_time(events, event_time).select(arrival_delay(event_time, as_of).alias("_delay"))
    if approximate:
        p95 = F.percentile_approx("_delay", PERCENTILE, accuracy).cast("double")
        return delays.agg(F.max("_delay").alias(names[0]), F.avg("_delay").alias(names[1]), p95.alias(names[2]))
    return _exact_stats(delays.withColumn("_times", F.lit(1)), names)


def second_counts(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """``second, n``: how many events each second of event time has.

    Counts of parts of the events add up to those of all, whatever the time the
    delay is taken at, so a history kept this way grows by its new events alone.
    """
    known = with_event_time(events, event_time)
    return known.groupBy(F.unix_timestamp(event_time).alias("second")).agg(F.count("*").alias("n"))


def counted_delay_stats(counts: DataFrame, *, as_of: Column | str | None = None, suffix: str = "s") -> DataFrame:
    """:func:`delay_stats` of the events that ``counts`` (``second, n``) stands for, the same to the last digit."""
    names = [f"{part}_delay_{suffix}" for part in ("max", "avg", "p95")]
    seconds = counts.select(F.timestamp_seconds("second").alias("at"), "n")
    return _exact_stats(seconds.select(arrival_delay("at", as_of).alias("_delay"), F.col("n").alias("_times")), names)


def _exact_stats(delays: DataFrame, names: list[str]) -> DataFrame:
    """Statistics of ``_delay``, each counted ``_times`` times."""
    bucketed = delays.withColumn("_bucket", F.floor(F.col("_delay") / _BUCKET_SECONDS))
    days = bucketed.groupBy("_bucket").agg(
        F.sum("_times").alias("_n"),
        F.max("_delay").alias("_max"),
        F.sum(F.col("_delay") * F.col("_times")).cast("decimal(38,0)").alias("_sum"),
    )
    # One row per day of delay from here on, so the running count is small.
    everything = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_n").over(everything)
    rank = (total - 1) * F.lit(PERCENTILE)
    ranked = days.select(
        "_bucket",
        (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"),
        F.sum("_n").over(so_far).alias("_through"),
        rank.alias("_rank"),
        F.max("_max").over(everything).alias("_max"),
        (F.sum("_sum").over(everything).cast("double") / total).alias("_avg"),
    )
    low, high = F.floor("_rank"), F.ceil("_rank")
    hit = ranked.filter((F.col("_before") <= high) & (F.col("_through") > low))

    # ``hit`` has at most two rows: the days holding the two neighbouring ranks.
    seconds = bucketed.join(F.broadcast(hit), "_bucket").groupBy("_bucket", "_delay").agg(
        F.sum("_times").alias("_n"),
        *[F.first(name).alias(name) for name in ("_before", "_rank", "_max", "_avg")],
    )
    within = Window.partitionBy("_bucket").orderBy("_delay")
    placed = seconds.withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
    ends = placed.agg(
        F.max("_max").alias(names[0]),
        F.max("_avg").alias(names[1]),
        F.max("_rank").alias("_rank"),
        F.min(F.when(F.col("_upto") > low, F.col("_delay"))).alias("_low"),
        F.min(F.when(F.col("_upto") > high, F.col("_delay"))).alias("_high"),
    )
    share = F.col("_rank") - F.floor("_rank")
    value = F.col("_low") + (F.col("_high") - F.col("_low")) * share
    return ends.select(names[0], names[1], value.cast("double").alias(names[2]))


def delay_minutes(
    p95: Column,
    *,
    max_delay: str = MAX_DELAY,
    min_delay: str = MIN_DELAY,
    unit_compat: bool = False,
) -> Column:
    """Whole minutes of watermark delay for a 95th-percentile delay in seconds.

    The percentile plus a fifth, cut to whole minutes and kept between the
    bounds; without a percentile, or with zero, five minutes plus a fifth.
    ``unit_compat`` keeps the recorded formula, which treats the seconds as
    milliseconds and so nearly always ends at ``min_delay``.
    """
    per_minute = _COMPAT_UNITS_PER_MINUTE if unit_compat else 60
    assumed = _COMPAT_ASSUMED if unit_compat else ASSUMED_DELAY_SECONDS
    known = F.coalesce(F.nullif(p95.cast("double"), F.lit(0.0)), F.lit(float(assumed)))
    raw = (known / per_minute * SAFETY_FACTOR).cast("bigint")
    floor, ceiling = F.lit(bound_minutes(min_delay, unit_compat)), F.lit(bound_minutes(max_delay, unit_compat))
    return F.least(F.greatest(raw, floor), ceiling)


def estimate_delay(
    history: DataFrame,
    *,
    max_delay: str = MAX_DELAY,
    min_delay: str = MIN_DELAY,
    as_of: Column | str | None = None,
    event_time: str = "event_time",
    approximate: bool = False,
    unit_compat: bool = False,
) -> str:
    """The watermark delay, such as ``"7 minutes"``, that suits a batch of past events.

    This runs a job and brings its single value to the driver: a watermark has
    to be known before its query starts.
    """
    if history.isStreaming:
        raise ValueError("the delay is estimated from batch data; pass a bounded history of the stream")
    stats = delay_stats(history, as_of=as_of, event_time=event_time, approximate=approximate)
    return _chosen(stats, max_delay, min_delay, unit_compat)


def estimate_delay_of_counts(
    counts: DataFrame,
    *,
    max_delay: str = MAX_DELAY,
    min_delay: str = MIN_DELAY,
    as_of: Column | str | None = None,
    unit_compat: bool = False,
) -> str:
    """As :func:`estimate_delay`, from the counts per second that a history is kept as."""
    return _chosen(counted_delay_stats(counts, as_of=as_of), max_delay, min_delay, unit_compat)


def _chosen(stats: DataFrame, max_delay: str, min_delay: str, unit_compat: bool) -> str:
    minutes = delay_minutes(F.col("p95_delay_s"), max_delay=max_delay, min_delay=min_delay, unit_compat=unit_compat)
    return stats.select(delay_label(minutes)).first()[0]


def delay_label(minutes: Column) -> Column:
    """The delay as a watermark takes it, such as ``"7 minutes"``."""
    return F.concat(minutes.cast("string"), F.lit(" minutes"))


def adaptive_sliding(
    events: DataFrame,
    window_duration: str = "10 minutes",
    sliding_duration: str = "2 minutes",
    *,
    max_event_delay: str = MAX_DELAY,
    min_event_delay: str = MIN_DELAY,
    history: DataFrame | None = None,
    as_of: Column | str | None = None,
    approximate: bool = False,
    unit_compat: bool = False,
    measures: Measures = FULL,
    event_time: str = "event_time",
) -> DataFrame:
    """Sliding windows under an estimated watermark, with the delay as a column.

    The estimate comes from ``history``, by default the events themselves. A
    stream cannot be looked at before it starts, so there ``history`` is needed,
    and a job finds its delay, which the watermark needs. A batch has no
    watermark: the delay is a label, found by a subquery when the rows are
    wanted, and building the plan starts no job.
    """
    past = events if history is None else history
    bounds = dict(max_delay=max_event_delay, min_delay=min_event_delay, unit_compat=unit_compat)
    stats = dict(as_of=as_of, event_time=event_time, approximate=approximate)
    layout = dict(measures=measures, event_time=event_time)
    if events.isStreaming:
        delay = estimate_delay(past, **bounds, **stats)
        return static_sliding(events, window_duration, sliding_duration, delay=delay, **layout)
    if past.isStreaming:
        raise ValueError("the delay is estimated from batch data; pass a bounded history of the stream")
    label = delay_label(delay_minutes(F.col("p95_delay_s"), **bounds))
    found = delay_stats(past, **stats).select(label.alias("delay")).scalar()
    rows = static_sliding(events, window_duration, sliding_duration, **layout)
    return rows.withColumn("watermark_delay", found)
