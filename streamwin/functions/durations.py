"""Duration strings: whole minutes for delay bounds, microseconds for window widths."""

from __future__ import annotations

import re

# Unit names and what a bound counts when it is not "<digits> <unit>".
MINUTE_UNITS = ("minute", "minutes", "min", "mins")
SECOND_UNITS = ("second", "seconds", "sec", "secs")
HOUR_UNITS = ("hour", "hours")
FALLBACK_MINUTES = 5

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_SHORT = {"min": "minute", "sec": "second"}
_TERM = re.compile(r"(\d+)\s+([a-z]+)\s*")


def bound_minutes(text: str, unit_compat: bool = False) -> int:
    """Whole minutes of a delay bound such as ``"30 seconds"`` or ``"1 hour 30 minutes"``.

    Seconds round down but never below one minute; what is no fixed-length
    interval is an error. ``unit_compat`` keeps the recorded rules: an unknown
    unit counts as minutes, and anything that is not one number and one unit is
    5 minutes.
    """
    if not unit_compat:
        return max(1, interval_micros(text) // _UNIT_MICROS["minute"])
    words = text.split()
    if len(words) != 2 or not words[0].isdigit():
        return FALLBACK_MINUTES
    amount, unit = int(words[0]), words[1].lower()
    if unit in SECOND_UNITS:
        return max(1, amount // 60)
    if unit in HOUR_UNITS:
        return 60 * amount
    return amount


def interval_micros(text: str) -> int:
    """Exact width of a fixed-length Spark interval such as ``"1 hour 30 minutes"``."""
    rest = text.strip().lower().removeprefix("interval").strip()
    total, at = 0, 0
    while at < len(rest):
        term = _TERM.match(rest, at)
        unit = term and term.group(2).removesuffix("s")
        unit = _SHORT.get(unit, unit)
        if unit not in _UNIT_MICROS:
            raise ValueError(f"not a fixed-length interval: {text!r}")
        total += int(term.group(1)) * _UNIT_MICROS[unit]
        at = term.end()
    if total <= 0:
        raise ValueError(f"interval must be longer than zero: {text!r}")
    return total


def micros_interval(micros: int) -> str:
    """The interval string Spark accepts for a width in microseconds."""
    return f"{micros} microseconds"
