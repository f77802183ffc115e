from .delay import (
    adaptive_sliding,
    counted_delay_stats,
    delay_minutes,
    delay_stats,
    estimate_delay,
    estimate_delay_of_counts,
    second_counts,
)
from .keyed import keyed_multi_granularity, keyed_session, keyed_sliding, keyed_tumbling
from .sessions import session
from .windows import hybrid, multi_granularity, sliding, static_sliding, tumbling

__all__ = [
    "adaptive_sliding",
    "counted_delay_stats",
    "delay_minutes",
    "delay_stats",
    "estimate_delay",
    "estimate_delay_of_counts",
    "hybrid",
    "keyed_multi_granularity",
    "keyed_session",
    "keyed_sliding",
    "keyed_tumbling",
    "multi_granularity",
    "second_counts",
    "session",
    "sliding",
    "static_sliding",
    "tumbling",
]
