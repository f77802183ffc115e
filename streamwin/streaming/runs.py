"""Running streams: settings for scale, bounded runs, and finishing what is available."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .progress import record_progress

# State lives in RocksDB, which outgrows memory and checkpoints only changes, and
# events of one session that meet in a task are merged before the shuffle, so a
# busy key sends its sessions and not its events.
SCALE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set options for the queries started inside; each keeps its own copy of them."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_at_scale(
    spark: SparkSession, writer: DataStreamWriter, state_partitions: int | None = None
) -> StreamingQuery:
    """Start a writer under :data:`SCALE_CONF`, except where the session has its own setting.

    ``state_partitions`` is the number of shuffle partitions of this query
    alone, by default the session's. Every micro-batch opens the state of every
    partition, so a query with few keys is better off with fewer. The number is
    fixed by the first start on a checkpoint, as is the kind of state store.
    """
    record_progress(spark)
    conf = {name: value for name, value in SCALE_CONF.items() if spark.conf.get(name, None) is None}
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_conf(spark, conf):
        return writer.start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; a failure inside it is raised here."""
    query.awaitTermination()
    return query


def run_for(queries: Iterable[StreamingQuery], seconds: float) -> None:
    """Let queries run together for a while, then stop them all.

    Returns earlier when all have ended; when one fails, stops the rest and
    raises its error.
    """
    queries = list(queries)
    until = time.monotonic() + seconds
    try:
        while any(query.isActive for query in queries) and time.monotonic() < until:
            failed = [error for query in queries if (error := query.exception()) is not None]
            if failed:
                raise failed[0]
            time.sleep(min(0.2, max(0.0, until - time.monotonic())))
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        if (error := query.exception()) is not None:
            raise error
