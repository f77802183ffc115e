"""Small column and projection helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_event_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Turn a textual event time into a timestamp; a timestamp passes through."""
    return df.withColumn(column, F.to_timestamp(column))


def with_event_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Keep only the rows that have an event time."""
    return df.filter(F.col(column).isNotNull())


def cast_or_null(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in place; text that does not parse becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def arrival_delay(event_time: str = "event_time", as_of: Column | str | None = None) -> Column:
    """Whole seconds between an event and ``as_of``, a column or the text of a time.

    The default is the time at which the query starts.
    """
    if as_of is None:
        now = F.current_timestamp()
    else:
        now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return F.unix_timestamp(now) - F.unix_timestamp(F.col(event_time))


def window_bounds(struct: str = "window", start: str = "window_start", end: str = "window_end") -> list[Column]:
    """The two bounds of a window struct as columns of their own."""
    return [F.col(f"{struct}.start").alias(start), F.col(f"{struct}.end").alias(end)]


def tagged(df: DataFrame, **tags: str) -> DataFrame:
    """Append constant label columns."""
    return df.withColumns({name: F.lit(text) for name, text in tags.items()})
