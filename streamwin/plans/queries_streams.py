"""Registered queries that run the windows as streams to their end and read back what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.measures import COUNT_ONLY
from ..schema import EVENT_SCHEMA, EVENT_TABLE_SCHEMA, market_view
from ..sources import stream_events, write_events
from ..streaming import (
    AVAILABLE_NOW,
    ROWS_A_FILE,
    VersionedTable,
    add_slices,
    arrival_slice,
    finish,
    record_progress,
    session_conf,
    start_files,
    start_jdbc,
    start_snapshots,
    start_upserts,
    write_even_slices,
)
from .queries_windows import FULL_EXACT, PAIR_EXACT, event_table, events_of, hybrid_sql, multi_sql, zoneless
from .scratch import scratch_folder
from .strategies import counted_adaptive_cycle
from .sql import (
    BOUNDS,
    COUNT,
    FULL_SQL,
    LATE_DROPPED_SQL,
    PAIR_SQL,
    adaptive_cycles_sql,
    closed_sql,
    late_sessions_sql,
    late_windows_sql,
    session_sql,
    sliding_sql,
    tumbling_sql,
)


def stream_of(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream, whether it is one file or a folder of files.

    A stream of files takes a single file only by way of a pattern.
    """
    path = f"{folder}/events.parque[t]"
    return market_view(stream_events(spark, path, EVENT_TABLE_SCHEMA, file_format="parquet"))


def _through_files(build: Callable[[DataFrame], DataFrame]):
    """Run a streaming plan over all events into parquet; the result is what was stored.

    All available files form one micro-batch. Nothing in it is late, whatever
    the order of the files, and the windows still open at its end stay unwritten.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return zoneless(_stored(spark, build(stream_of(spark, folder))))

    return query


def _stored(spark: SparkSession, result: DataFrame) -> DataFrame:
    place = scratch_folder(spark, "stream")
    running = start_files(
        result,
        "result",
        output_root=f"{place}/out",
        checkpoint_root=f"{place}/checkpoint",
        trigger=AVAILABLE_NOW,
        state_partitions=_state_partitions(spark),
    )
    finish(running)
    return spark.read.schema(result.schema).parquet(f"{place}/out/result")


def _state_partitions(spark: SparkSession) -> int | None:
    """One per core on a single machine; on a cluster what the session says."""
    local = spark.conf.get("spark.master", "").startswith("local")
    return spark.sparkContext.defaultParallelism if local else None


def _json_files(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as JSON lines and followed as a stream of files."""
    place = scratch_folder(spark, "events")
    write_events(events_of(spark, folder), place)
    events = stream_events(spark, place, EVENT_SCHEMA)
    return zoneless(_stored(spark, op.tumbling(events, measures=FULL_EXACT)))


def _per_batch_table(spark: SparkSession, folder: str) -> DataFrame:
    """The JDBC sink with its write pointed at files: every micro-batch stored once, under its id."""
    place = scratch_folder(spark, "batches")
    result = op.keyed_tumbling(stream_of(spark, folder), measures=PAIR_EXACT)

    def save(batch: DataFrame, options: dict[str, str]) -> None:
        """Replace what an earlier attempt at this batch left; each batch is handed over twice."""
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
        for _ in range(2):
            writer.parquet(f"{place}/{options['dbtable']}")

    running = start_jdbc(
        result,
        "session",
        options={},
        checkpoint_root=f"{place}/checkpoint",
        trigger=AVAILABLE_NOW,
        save=save,
        clear_batch=lambda table, batch_id: None,
        state_partitions=_state_partitions(spark),
    )
    finish(running)
    return zoneless(spark.read.parquet(f"{place}/session_aggregations").select(result.columns))


# Fixed values of the replay: one event in ten comes up to twelve days after its time, the others within minutes.
SLICE = "5 days"
SLICES = 10
REPLAY_DELAY = "12 hours"


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with the number of the slice in which an event arrives."""
    late = F.col("event_id") % 10 == 0
    minutes = F.when(late, F.col("event_id") * 7919 % 17280).otherwise(F.col("event_id") % 7)
    arrival = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + minutes * 60_000_000)
    return event_table(spark, folder).withColumn("slice", arrival_slice(arrival, SLICE))


def _replayed(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of slices, one micro-batch each, many of them late."""
    place = scratch_folder(spark, "replay")
    files = f"{place}/files"
    each = write_even_slices(arrivals(spark, folder), files, "slice", staged=f"{place}/staged")
    return market_view(
        stream_events(spark, files, EVENT_TABLE_SCHEMA, file_format="parquet", max_files_per_trigger=each)
    )


def _through_slices(build: Callable[[DataFrame], DataFrame]):
    return lambda spark, folder: zoneless(_stored(spark, build(_replayed(spark, folder))))


def _late_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions over many micro-batches. Each event's lateness is judged by itself, however events lie in files."""
    with session_conf(spark, {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "false"}):
        result = op.session(_replayed(spark, folder), delay=REPLAY_DELAY, measures=FULL_EXACT)
        return zoneless(_stored(spark, result))


def _late_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Of each micro-batch that read any: the rows read and the windows whose rows came too late, as the query's progress says."""
    result = op.tumbling(_replayed(spark, folder), delay=REPLAY_DELAY, measures=COUNT_ONLY)
    place = scratch_folder(spark, "late")
    running = start_files(
        result,
        "result",
        output_root=place,
        checkpoint_root=f"{place}/checkpoint",
        trigger=AVAILABLE_NOW,
        state_partitions=_state_partitions(spark),
    )
    batches = record_progress(spark).batches(finish(running))
    rows = [(batch["batch"], batch["input_rows"], batch["late_rows"]) for batch in batches if batch["input_rows"]]
    return spark.createDataFrame(rows, "batch long, input_rows long, late_windows long")


def _late_restarts(spark: SparkSession, folder: str) -> DataFrame:
    """A run for every slice, each taking up state and watermark where the last one ended."""
    place = scratch_folder(spark, "restarts")
    files, schema = f"{place}/files", None
    slices = dict(staged=f"{place}/staged", most_rows=ROWS_A_FILE)
    for _ in add_slices(arrivals(spark, folder), files, "slice", files=2, **slices):
        events = market_view(stream_events(spark, files, EVENT_TABLE_SCHEMA, file_format="parquet"))
        result = op.tumbling(events, delay=REPLAY_DELAY, measures=FULL_EXACT)
        schema = result.schema
        running = start_files(
            result,
            "result",
            output_root=f"{place}/out",
            checkpoint_root=f"{place}/checkpoint",
            trigger=AVAILABLE_NOW,
            state_partitions=_state_partitions(spark),
        )
        finish(running)
    if schema is None:
        return zoneless(op.tumbling(events_of(spark, folder), measures=FULL_EXACT).limit(0))
    return zoneless(spark.read.schema(schema).parquet(f"{place}/out/result"))


COUNTED_AS_OF = "2024-01-04 00:00:00"


def _adaptive_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """A cycle for every slice, each with the delay that the events so far suggest."""
    place = scratch_folder(spark, "cycles")
    files, cycles = f"{place}/files", 0
    for _ in add_slices(arrivals(spark, folder), files, "slice", staged=f"{place}/staged", most_rows=ROWS_A_FILE):
        cycles += 1
        counted_adaptive_cycle(
            market_view(stream_events(spark, files, EVENT_TABLE_SCHEMA, file_format="parquet")),
            output_root=f"{place}/out",
            checkpoint_root=f"{place}/checkpoint",
            counts_root=f"{place}/counts",
            as_of=COUNTED_AS_OF,
            max_event_delay="72 hours",
            measures=FULL_EXACT,
            state_partitions=_state_partitions(spark),
        )
    shape = op.static_sliding(events_of(spark, folder), "5 minutes", "1 minute", measures=FULL_EXACT).schema
    written = spark.read.schema(shape).parquet(f"{place}/out/adaptive") if cycles else spark.createDataFrame([], shape)
    return zoneless(written)


class _Crash(Exception):
    pass


def _kept_table(start, build, keys=(), crash_at: int | None = None, **options):
    """Keep a table over many micro-batches and read it; none of its events is too late for a delay of a month.

    With ``crash_at`` the run fails once, after that batch is written and before
    it is committed, and is started again.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        place = scratch_folder(spark, "table")
        result = build(_replayed(spark, folder))
        table = VersionedTable(f"{place}/table", result.schema, keys)
        waiting = {crash_at}

        def crash(batch: int) -> None:
            if batch in waiting:
                waiting.clear()
                raise _Crash(f"after writing batch {batch}")

        settings = dict(checkpoint_dir=f"{place}/checkpoint", trigger=AVAILABLE_NOW, before_commit=crash, **options)
        running = start(result, table, state_partitions=_state_partitions(spark), **settings)
        try:
            finish(running)
        except StreamingQueryException as failure:
            if "_Crash" not in str(failure):
                raise
            finish(start(result, table, state_partitions=_state_partitions(spark), **settings))
        return zoneless(table.read(spark))

    return query


_BOUNDS_AND = ["window_start", "window_end"]

QUERIES = {
    "stream_late_tumbling": _through_slices(lambda ev: op.tumbling(ev, delay=REPLAY_DELAY, measures=FULL_EXACT)),
    "stream_late_multi": _through_slices(lambda ev: op.multi_granularity(ev, delay=REPLAY_DELAY, measures=FULL_EXACT)),
    "stream_late_session": _late_sessions,
    "stream_late_dropped": _late_dropped,
    "stream_late_restarts": _late_restarts,
    "stream_adaptive": _adaptive_cycles,
    "stream_update_hybrid": _kept_table(
        start_upserts,
        lambda ev: op.hybrid(ev, delay="30 days", measures=FULL_EXACT),
        ["window_type", *_BOUNDS_AND],
        fold_every=4,
    ),
    "stream_update_multi": _kept_table(
        start_upserts,
        lambda ev: op.multi_granularity(ev, delay="30 days", measures=FULL_EXACT),
        ["granularity", *_BOUNDS_AND],
    ),
    "stream_complete_tumbling": _kept_table(
        start_snapshots, lambda ev: op.tumbling(ev, delay="30 days", measures=FULL_EXACT)
    ),
    "stream_after_crash": _kept_table(
        start_upserts,
        lambda ev: op.tumbling(ev, delay="30 days", measures=FULL_EXACT),
        _BOUNDS_AND,
        crash_at=5,
        fold_every=3,
    ),
    "stream_multi_union": _through_files(
        lambda ev: op.multi_granularity(ev, measures=FULL_EXACT, single_scan=False)
    ),
    "stream_symbol_multi_union": _through_files(
        lambda ev: op.keyed_multi_granularity(ev, measures=PAIR_EXACT, single_scan=False)
    ),
    "stream_tumbling": _through_files(lambda ev: op.tumbling(ev, measures=FULL_EXACT)),
    "stream_sliding": _through_files(lambda ev: op.sliding(ev, measures=FULL_EXACT)),
    "stream_session": _through_files(lambda ev: op.session(ev, measures=FULL_EXACT)),
    "stream_hybrid": _through_files(lambda ev: op.hybrid(ev, measures=FULL_EXACT)),
    "stream_hybrid_union": _through_files(lambda ev: op.hybrid(ev, measures=FULL_EXACT, shared=False)),
    "stream_multi": _through_files(lambda ev: op.multi_granularity(ev, measures=FULL_EXACT)),
    "stream_multi_single_scan": _through_files(
        lambda ev: op.multi_granularity(ev, measures=FULL_EXACT, single_scan=True)
    ),
    "stream_count": _through_files(lambda ev: op.tumbling(ev, "1 minute", delay="1 minute", measures=COUNT_ONLY)),
    "stream_symbol_tumbling": _through_files(lambda ev: op.keyed_tumbling(ev, measures=PAIR_EXACT)),
    "stream_symbol_sliding": _through_files(lambda ev: op.keyed_sliding(ev, measures=PAIR_EXACT)),
    "stream_symbol_multi": _through_files(lambda ev: op.keyed_multi_granularity(ev, measures=PAIR_EXACT)),
    "stream_symbol_session": _through_files(lambda ev: op.keyed_session(ev, measures=PAIR_EXACT)),
    "stream_json_files": _json_files,
    "stream_per_batch_table": _per_batch_table,
}

# The single-scan form reports a window when the quarter of an hour around it closes.
_WIDEST = "time_bucket(interval '15 minutes', window_start) + interval '15 minutes'"

ORACLES = {
    "stream_late_tumbling": late_windows_sql(("5 minutes",)),
    "stream_late_multi": late_windows_sql(("1 minute", "5 minutes", "15 minutes"), tagged=True),
    "stream_late_session": late_sessions_sql("30 minutes", SLICES),
    "stream_late_dropped": LATE_DROPPED_SQL,
    "stream_late_restarts": late_windows_sql(("5 minutes",), lag=1),
    "stream_adaptive": adaptive_cycles_sql(COUNTED_AS_OF, 1, 72 * 60),
    "stream_update_hybrid": hybrid_sql(),
    "stream_update_multi": multi_sql(FULL_SQL),
    "stream_complete_tumbling": tumbling_sql("5 minutes", FULL_SQL),
    "stream_after_crash": tumbling_sql("5 minutes", FULL_SQL),
    "stream_multi_union": closed_sql(multi_sql(FULL_SQL), "30 minutes"),
    "stream_symbol_multi_union": closed_sql(multi_sql(PAIR_SQL, "symbol"), "5 minutes"),
    "stream_tumbling": closed_sql(tumbling_sql("5 minutes", FULL_SQL), "5 minutes"),
    "stream_sliding": closed_sql(sliding_sql("5 minutes", "1 minute", 5, FULL_SQL), "5 minutes"),
    "stream_session": closed_sql(session_sql("30 minutes", FULL_SQL, "user_id"), "10 minutes", "session_end"),
    "stream_hybrid": closed_sql(hybrid_sql(), "5 minutes"),
    "stream_hybrid_union": closed_sql(hybrid_sql(), "5 minutes"),
    "stream_multi": closed_sql(multi_sql(FULL_SQL), "30 minutes"),
    "stream_multi_single_scan": closed_sql(multi_sql(FULL_SQL), "30 minutes", _WIDEST),
    "stream_count": closed_sql(tumbling_sql("1 minute", COUNT), "1 minute"),
    "stream_symbol_tumbling": closed_sql(tumbling_sql("2 minutes", PAIR_SQL, "symbol"), "5 minutes"),
    "stream_symbol_sliding": closed_sql(sliding_sql("2 minutes", "1 minute", 2, PAIR_SQL, "symbol"), "5 minutes"),
    "stream_symbol_multi": closed_sql(multi_sql(PAIR_SQL, "symbol"), "5 minutes"),
    "stream_symbol_session": closed_sql(session_sql("2 minutes", PAIR_SQL, "symbol", *BOUNDS), "5 minutes"),
    "stream_json_files": closed_sql(tumbling_sql("5 minutes", FULL_SQL), "5 minutes"),
    "stream_per_batch_table": closed_sql(tumbling_sql("2 minutes", PAIR_SQL, "symbol"), "5 minutes"),
}
