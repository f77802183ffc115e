"""Stream writers: a checkpointed base and the console, memory, file, table and JDBC sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .progress import record_progress
from .runs import start_at_scale

# Trigger intervals.
BUILDER_TRIGGER = "10 seconds"
FILE_TRIGGER = "30 seconds"
JDBC_TRIGGER = "10 seconds"

# Output modes Spark accepts for each kind of plan. Sessions and chained
# aggregations cannot report updates.
OUTPUT_MODES = {
    "window": ("append", "update", "complete"),
    "union": ("append", "update", "complete"),
    "session": ("append", "complete"),
    "chained": ("append",),
}

AVAILABLE_NOW = {"availableNow": True}

_ROOT = "spark.sql.streaming.checkpointLocation"


def set_checkpoint_root(spark: SparkSession, path: str) -> str:
    """Keep the checkpoints of this session's queries below ``path``, a folder all executors share."""
    spark.conf.set(_ROOT, path)
    return path


def checkpointed_writer(
    result: DataFrame,
    output_mode: str = "update",
    checkpoint_dir: str | None = None,
    query_name: str | None = None,
    trigger: str | dict | None = BUILDER_TRIGGER,
) -> DataStreamWriter:
    """A writer with output mode, checkpoint, trigger and name set, not yet started.

    ``trigger`` is a processing-time interval, the keywords of
    ``DataStreamWriter.trigger``, or ``None`` for back-to-back batches. Without
    a checkpoint folder the query needs a name, and its checkpoint lies under
    that name below the session's checkpoint root. Start the writer with
    ``start_at_scale`` to have the settings for large state.
    """
    record_progress(result.sparkSession)
    if checkpoint_dir is None:
        root = result.sparkSession.conf.get(_ROOT, None)
        if not root or not query_name:
            raise ValueError("name a checkpoint folder, or the query below a root set by set_checkpoint_root")
        checkpoint_dir = f"{root}/{query_name}"
    writer = result.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_dir)
    return _triggered(writer.queryName(query_name) if query_name else writer, trigger)


def console_writer(result: DataFrame, output_mode: str = "update", query_name: str = "console_output") -> DataStreamWriter:
    """Print every batch in full, for looking at a stream during development."""
    record_progress(result.sparkSession)
    return result.writeStream.outputMode(output_mode).format("console").option("truncate", False).queryName(query_name)


def memory_writer(result: DataFrame, table_name: str, output_mode: str = "update") -> DataStreamWriter:
    """Keep the result as a table in the driver's memory: for small results and tests only."""
    record_progress(result.sparkSession)
    return result.writeStream.outputMode(output_mode).format("memory").queryName(table_name)


def start_files(
    result: DataFrame,
    window_type: str = "default",
    *,
    output_root: str,
    checkpoint_root: str,
    file_format: str = "parquet",
    trigger: str | dict | None = FILE_TRIGGER,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to files below ``output_root``, one folder per window type, exactly once."""
    writer = result.writeStream.format(file_format).outputMode("append").options(**(options or {}))
    writer = writer.option("path", f"{output_root}/{window_type}")
    writer = writer.option("checkpointLocation", f"{checkpoint_root}/{window_type}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return start_at_scale(result.sparkSession, _triggered(writer, trigger), state_partitions)


def start_delta(
    result: DataFrame,
    window_type: str = "default",
    *,
    output_root: str,
    checkpoint_root: str,
    trigger: str | dict | None = None,
    **options,
) -> StreamingQuery:
    """Append to a Delta table; needs the Delta connector on the class path."""
    return start_files(
        result,
        f"delta/{window_type}",
        output_root=output_root,
        checkpoint_root=checkpoint_root,
        file_format="delta",
        trigger=trigger,
        **options,
    )


def jdbc_batch_writer(
    options: dict[str, str],
    table: str,
    clear_batch: Callable[[str, int], None] | None = None,
    save: Callable[[DataFrame, dict[str, str]], None] | None = None,
    batch_column: str | None = "batch_id",
    at_least_once: bool = False,
) -> Callable[[DataFrame, int], None]:
    """What a JDBC sink does with a micro-batch: append it, marked with its number.

    After a failure Spark hands the same batch over again. ``clear_batch``,
    given the table and the number, deletes what an earlier attempt left, so
    that the batch is stored once. Without it the caller has to accept rows
    stored twice by ``at_least_once=True``. ``batch_column=None`` writes to a
    table that has no column for the number. ``save`` replaces the JDBC write.
    """
    if clear_batch is None and not at_least_once:
        raise ValueError("pass clear_batch, or at_least_once=True if a batch may be stored twice")
    target = {**options, "dbtable": table}

    def write(batch: DataFrame, batch_id: int) -> None:
        if clear_batch is not None:
            clear_batch(table, batch_id)
        if batch_column is not None:
            batch = batch.withColumn(batch_column, F.lit(batch_id).cast("bigint"))
        (save or _save_jdbc)(batch, target)

    return write


def start_jdbc(
    result: DataFrame,
    window_type: str = "default",
    *,
    options: dict[str, str],
    checkpoint_root: str,
    trigger: str | dict | None = JDBC_TRIGGER,
    clear_batch: Callable[[str, int], None] | None = None,
    save: Callable[[DataFrame, dict[str, str]], None] | None = None,
    batch_column: str | None = "batch_id",
    at_least_once: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to the table ``<window_type>_aggregations``. ``options`` holds url, user, driver and so on."""
    write = jdbc_batch_writer(options, f"{window_type}_aggregations", clear_batch, save, batch_column, at_least_once)
    writer = result.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", f"{checkpoint_root}/{window_type}")
    return start_at_scale(result.sparkSession, _triggered(writer, trigger), state_partitions)


def _save_jdbc(batch: DataFrame, options: dict[str, str]) -> None:
    batch.write.format("jdbc").options(**options).mode("append").save()


def _triggered(writer: DataStreamWriter, trigger: str | dict | None) -> DataStreamWriter:
    if trigger is None:
        return writer
    return writer.trigger(**({"processingTime": trigger} if isinstance(trigger, str) else trigger))
