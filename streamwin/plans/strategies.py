"""The ready-made sets of strategies: live over events, live per symbol, and timed in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.measures import BASELINE, FULL, Measures
from ..operators import (
    adaptive_sliding,
    estimate_delay_of_counts,
    hybrid,
    keyed_multi_granularity,
    keyed_session,
    keyed_sliding,
    keyed_tumbling,
    multi_granularity,
    second_counts,
    session,
    static_sliding,
    tumbling,
)
from ..sources import decode_text_messages
from ..streaming import (
    AVAILABLE_NOW,
    VersionedTable,
    checkpointed_writer,
    finish,
    progress_samples,
    start_at_scale,
    start_files,
)

# Settings of the live run over events.
LIVE_SESSION_GAP = "10 minutes"
LIVE_ADAPTIVE = {
    "window_duration": "5 minutes",
    "sliding_duration": "1 minute",
    "max_event_delay": "15 minutes",
    "min_event_delay": "30 seconds",
}
# How the metrics name each live strategy, and its watermark delay.
LIVE_LABELS = {
    "session": ("Session Window", "10 minutes"),
    "hybrid": ("Hybrid Window", "5 minutes"),
    "multi": ("Multi-Granularity Window", "30 minutes"),
    "adaptive": ("Adaptive Window", "unknown"),
}


def live_strategies(events: DataFrame, history: DataFrame | None = None) -> dict[str, DataFrame]:
    """Session, hybrid and multi-granularity results of an event stream.

    With a batch of past events as ``history`` the adaptive strategy joins
    them, its delay estimated from that history.
    """
    results = {
        "session": session(events, LIVE_SESSION_GAP),
        "hybrid": hybrid(events),
        "multi": multi_granularity(events),
    }
    if history is not None:
        results["adaptive"] = adaptive_sliding(events, history=history, **LIVE_ADAPTIVE)
    return results


def start_live(
    spark: SparkSession,
    events: DataFrame,
    *,
    checkpoint_root: str,
    history: DataFrame | None = None,
    trigger: str | dict | None = "10 seconds",
    sink: Callable[[DataStreamWriter, str], DataStreamWriter] | None = None,
) -> dict[str, StreamingQuery]:
    """Start every live strategy on its own checkpoint; ``sink`` completes a writer.

    Without ``sink`` the results are printed. Sessions append, the others update.
    """
    started = {}
    for name, result in live_strategies(events, history).items():
        writer = checkpointed_writer(
            result,
            "append" if name == "session" else "update",
            f"{checkpoint_root}/{name}",
            f"{name}_window",
            trigger,
        )
        completed = sink(writer, name) if sink else writer.format("console").option("truncate", False)
        started[name] = start_at_scale(spark, completed)
    return started


def live_samples(queries: dict[str, StreamingQuery], adaptive_delay: str | None = None) -> list[tuple]:
    """Metric samples of the queries :func:`start_live` started, for ``progress_table``."""
    samples: list[tuple] = []
    for name, query in queries.items():
        window_type, delay = LIVE_LABELS[name]
        samples += progress_samples(query, window_type, adaptive_delay or delay if name == "adaptive" else delay)
    return samples


def adaptive_cycle(
    events: DataFrame,
    history: DataFrame,
    *,
    output_root: str,
    checkpoint_root: str,
    as_of: str | None = None,
    **options,
) -> StreamingQuery:
    """Process what has arrived with a delay estimated anew, then stop.

    Called again and again on the same folders, each call takes up where the
    last one ended. The watermark never moves back, so a longer delay than
    before holds for later events only.
    """
    result = adaptive_sliding(events, history=history, as_of=as_of, **{**LIVE_ADAPTIVE, **options})
    query = start_files(
        result, "adaptive", output_root=output_root, checkpoint_root=checkpoint_root, trigger=AVAILABLE_NOW
    )
    return finish(query)


def counted_adaptive_cycle(
    events: DataFrame,
    *,
    output_root: str,
    checkpoint_root: str,
    counts_root: str,
    as_of: str | None = None,
    window_duration: str = LIVE_ADAPTIVE["window_duration"],
    sliding_duration: str = LIVE_ADAPTIVE["sliding_duration"],
    max_event_delay: str = LIVE_ADAPTIVE["max_event_delay"],
    min_event_delay: str = LIVE_ADAPTIVE["min_event_delay"],
    measures: Measures = FULL,
    state_partitions: int | None = None,
) -> tuple[StreamingQuery, str]:
    """As :func:`adaptive_cycle`, but each event is read for the estimate only in the cycle it arrives in.

    The history is a table of event counts per second below ``counts_root``. A
    cycle adds the counts of what has arrived, estimates the delay from the
    whole table, which equals that of all events, and runs the windows. The
    query that was run and the delay chosen are returned.
    """
    counted = second_counts(events)
    history = VersionedTable(counts_root, counted.schema, ["second"], merge="sum")

    def add(batch: DataFrame, number: int) -> None:
        history.put_changes(second_counts(batch), number)

    writer = events.writeStream.foreachBatch(add).option("checkpointLocation", f"{checkpoint_root}/adaptive_counts")
    finish(start_at_scale(events.sparkSession, writer.trigger(**AVAILABLE_NOW)))
    delay = estimate_delay_of_counts(
        history.read(events.sparkSession), max_delay=max_event_delay, min_delay=min_event_delay, as_of=as_of
    )
    query = start_files(
        static_sliding(events, window_duration, sliding_duration, delay=delay, measures=measures),
        "adaptive",
        output_root=output_root,
        checkpoint_root=checkpoint_root,
        trigger=AVAILABLE_NOW,
        state_partitions=state_partitions,
    )
    return finish(query), delay


def symbol_strategies(events: DataFrame) -> dict[str, DataFrame]:
    """The four per-symbol results, by the window type their tables are named after."""
    return {
        "session": keyed_tumbling(events),
        "hybrid": keyed_sliding(events),
        "multi_granularity": keyed_multi_granularity(events),
        "adaptive": keyed_session(events),
    }


def start_symbol_strategies(
    messages: DataFrame, start: Callable[[DataFrame, str], StreamingQuery]
) -> dict[str, StreamingQuery]:
    """Decode text messages and hand each per-symbol result to ``start``, such as a JDBC sink."""
    events = decode_text_messages(messages)
    return {name: start(result, name) for name, result in symbol_strategies(events).items()}


def batch_strategies(events: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """The strategies compared on a batch, each as a function that builds its plan."""
    return {
        "Standard Window": lambda: tumbling(events, measures=BASELINE),
        "Session-Based Window": lambda: session(events),
        "Hybrid Window": lambda: hybrid(events),
        "Multi-Granularity Window": lambda: multi_granularity(events),
        "Adaptive Watermarked Window": lambda: static_sliding(events),
    }
