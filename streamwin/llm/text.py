"""Words, Arrow batches and scratch tables, as the operators of this package share them."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scratch import scratch_folder

# A word is a run of anything but the ASCII blanks. ``bytes.split`` parts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"

# Settings of the C allocator and of Arrow for Python workers.
_ALLOCATION = {
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}

# Rows turned into Python objects at a time, so that long texts don't pile up.
ROWS_AT_ONCE = 512


def texts(column: pa.Array) -> list[str]:
    """The values of a string column, nulls as empty texts."""
    return [value or "" for value in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, nulls as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches; empty ones are left out."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns every operator works on, under fixed names."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))


def nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed on every level, as returned by functions over Arrow tables."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(field.name, nullable(field.dataType)) for field in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind


def with_nulls(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """The same values under the Arrow type of :func:`nullable`."""
    kind = _with_nulls(column.type)
    # Types that differ in what may be null count as equal unless fields are compared.
    return column if kind.equals(column.type, check_metadata=True) else column.cast(kind)


def _with_nulls(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(field.name, _with_nulls(field.type), metadata=field.metadata) for field in kind])
    if pa.types.is_list(kind):
        field = kind.value_field
        return pa.list_(pa.field(field.name, _with_nulls(field.type), metadata=field.metadata))
    if pa.types.is_map(kind):
        key, item = kind.key_field, kind.item_field
        return pa.map_(key.with_type(_with_nulls(key.type)), pa.field(item.name, _with_nulls(item.type)))
    return kind


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the folder all executors share and read it back.

    The plans built on it are short, and a lost executor costs no recomputation.
    Spark deletes the shuffle files of a finished job when the driver collects
    its garbage, which may be much later; so that long queries don't pile them
    up, it is asked to do so here.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, purpose)
    frame.write.parquet(folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(folder)


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the library, installed or not.

    They also give freed arrays back at once: idle workers would otherwise keep
    the memory of the largest block they have seen.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    for name, value in _ALLOCATION.items():
        environment.setdefault(name, value)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_column: str = "doc_id"):
    """One row in five, by the CRC-32 of the id's digits, is never learned from. Null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, text_column: str = "text"
) -> DataFrame:
    """At most ``rows`` labelled texts to learn from, the same in every run.

    The ids are picked from ``labels`` alone, by hash; their number is bounded,
    so they are broadcast and no text is shuffled.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    wanted = id_and_text(docs, text_column=text_column)
    return wanted.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = ROWS_AT_ONCE):
    """A ``mapInArrow`` function that applies ``work`` to small batches."""

    def run(batches):
        for part in slices(batches, rows):
            yield work(part)

    return run
