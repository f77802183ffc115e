"""Progress of running queries as metric samples, every micro-batch of it."""

from __future__ import annotations

import json
import threading
import time
from collections import Counter, deque
from datetime import datetime, timezone
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..schema import METRIC_SCHEMA

# Batches of a run whose figures stay on the driver.
TAIL = 10_000

_logs: WeakKeyDictionary[SparkSession, ProgressLog] = WeakKeyDictionary()


class ProgressLog(StreamingQueryListener):
    """Keeps a few numbers of the micro-batches of every query started after it was attached.

    Sums run over all batches. Of the batches themselves the newest ``tail`` of
    each run stay, far more than a query itself remembers, so that a query
    that runs for months does not fill the driver; take their samples in time.
    """

    def __init__(self, tail: int = TAIL):
        self._changed = threading.Condition()
        self._tail = tail
        self._started: dict[str, datetime] = {}
        self._batches: dict[str, deque[dict]] = {}
        self._totals: dict[str, Counter[str]] = {}

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._started[str(event.runId)] = _time(event.timestamp)

    def onQueryProgress(self, event) -> None:
        batch = json.loads(event.progress.json)
        states = batch["stateOperators"]
        kept = {
            "batch": batch["batchId"],
            "at": _time(batch["timestamp"]),
            "latency": batch["durationMs"].get("triggerExecution", 0) / 1000.0,
            "throughput": batch.get("processedRowsPerSecond"),
            "memory": sum(state["memoryUsedBytes"] for state in states) / 2.0**20,
            "input_rows": batch["numInputRows"],
            "late_rows": sum(state["numRowsDroppedByWatermark"] for state in states),
        }
        with self._changed:
            run = batch["runId"]
            self._batches.setdefault(run, deque(maxlen=self._tail)).append(kept)
            self._started.setdefault(run, kept["at"])
            totals = self._totals.setdefault(run, Counter())
            totals.update(batches=1, input_rows=kept["input_rows"], late_rows=kept["late_rows"])
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def batches(self, query: StreamingQuery, timeout: float = 30.0) -> list[dict]:
        """The newest batches of a query, once its last one has arrived here."""
        run, last, until = str(query.runId), query.lastProgress, time.monotonic() + timeout
        with self._changed:
            while last is not None:
                known = self._batches.get(run)
                if known and (known[-1]["batch"], known[-1]["at"]) >= (last["batchId"], _time(last["timestamp"])):
                    break
                if not self._changed.wait(until - time.monotonic()) and time.monotonic() >= until:
                    raise RuntimeError("the progress of this query was not recorded; call record_progress before it starts")
            found = list(self._batches.get(run, []))
            begun = self._started.get(run, found[0]["at"] if found else None)
        return [{**batch, "elapsed": (batch["at"] - begun).total_seconds()} for batch in found]


    def knows(self, query: StreamingQuery) -> bool:
        with self._changed:
            return str(query.runId) in self._started

    def totals(self, query: StreamingQuery) -> dict[str, int]:
        """Batches, input rows and late rows of the whole run, once its last batch has arrived here."""
        self.batches(query)
        with self._changed:
            found = self._totals.get(str(query.runId), Counter())
            return {name: found[name] for name in ("batches", "input_rows", "late_rows")}


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def record_progress(spark: SparkSession) -> ProgressLog:
    """Attach a log to the session, once. The writers of this package do so before a query starts."""
    if spark not in _logs:
        log = ProgressLog()
        spark.streams.addListener(log)
        _logs[spark] = log
    return _logs[spark]


def _log(query: StreamingQuery) -> ProgressLog:
    """The log that has seen this run start, of whatever session."""
    logs = list(_logs.values())
    if not logs:
        raise RuntimeError("no progress was recorded; call record_progress before the query starts")
    return next((log for log in logs if log.knows(query)), logs[0])


def progress_samples(query: StreamingQuery, window_type: str, watermark_delay: str = "unknown") -> list[tuple]:
    """Samples of each micro-batch of the run that the log still has, in the order of ``METRIC_SCHEMA``.

    Latency is the duration of the batch in seconds, throughput its input rows
    per second, memory the state store's size in MB. ``elapsed`` is the time
    from the start of the query to that batch.
    """
    samples: list[tuple] = []
    for batch in _log(query).batches(query):
        for name in ("latency", "throughput", "memory", "input_rows", "late_rows", "elapsed"):
            samples.append((name, batch["at"], window_type, float(batch[name] or 0.0), None))
        samples.append(("watermark_delays", batch["at"], window_type, None, watermark_delay))
    return samples


def progress_table(spark: SparkSession, samples: list[tuple]) -> DataFrame:
    """Samples as a table for the roll-ups and for writing."""
    return spark.createDataFrame(samples, METRIC_SCHEMA)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late in the whole run."""
    return _log(query).totals(query)["late_rows"]
