from .columns import arrival_delay, cast_or_null, parse_event_time, tagged, window_bounds, with_event_time
from .durations import bound_minutes, interval_micros
from .measures import BASELINE, COUNT_AND_AVERAGE, COUNT_ONLY, FULL, Measures

__all__ = [
    "BASELINE",
    "COUNT_AND_AVERAGE",
    "COUNT_ONLY",
    "FULL",
    "Measures",
    "arrival_delay",
    "bound_minutes",
    "cast_or_null",
    "interval_micros",
    "parse_event_time",
    "tagged",
    "window_bounds",
    "with_event_time",
]
