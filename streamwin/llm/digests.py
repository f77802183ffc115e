"""Locality-sensitive digests of texts: quartiles of hashed byte triplets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import id_and_text, partitions, per_batch, slices, stored, texts

# Parameters of the digest; digests of different parameters don't compare.
BUCKETS = 256
LENGTH_STEPS = 16
LENGTH_WEIGHT = 12

_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_SHIFT = np.uint32(32 - (BUCKETS.bit_length() - 1))
_PLACES = np.array([0, 2, 4, 6], np.uint8)

# Difference of two bytes of four 2-bit codes each, summed over the codes.
_CODES = (np.arange(256, dtype=np.uint8)[:, None] >> _PLACES & 3).astype(np.int32)
_DIFFERENCE = np.abs(_CODES[:, None, :] - _CODES[None, :, :]).sum(axis=2)


def triplet_counts(data: bytes) -> np.ndarray:
    """How many triplets of neighbouring bytes fall into each bucket."""
    if len(data) < 3:
        return np.zeros(BUCKETS, np.int64)
    letters = np.frombuffer(data, np.uint8).astype(np.uint32)
    mixed = letters[:-2] * _MIX[0]
    mixed += letters[1:-1] * _MIX[1]
    mixed += letters[2:] * _MIX[2]
    mixed ^= mixed >> np.uint32(15)
    mixed *= _MIX[1]
    return np.bincount(mixed >> _SHIFT, minlength=BUCKETS)


def digest(data: bytes) -> str:
    """Length code, then the quartile each bucket's count lies in, two bits each, as hex.

    The length is coded in steps of a sixteenth of a doubling. Of less than
    three bytes only the length is told.
    """
    counts = triplet_counts(data)
    ordered = np.sort(counts)
    codes = np.zeros(BUCKETS, np.uint8)
    for quarter in (1, 2, 3):
        codes += counts > ordered[BUCKETS * quarter // 4]
    packed = (codes.reshape(-1, 4) << _PLACES).sum(axis=1).astype(np.uint8)
    return f"{_length_code(len(data)):03x}{packed.tobytes().hex()}"


def _length_code(size: int) -> int:
    return round(math.log2(size + 1) * LENGTH_STEPS)


def parse(value: str) -> tuple[int, np.ndarray]:
    return int(value[:3], 16), np.frombuffer(bytes.fromhex(value[3:]), np.uint8)


def likeness(one: str, other: str) -> float:
    """From 1 for equal digests down to 0.

    The difference score adds the steps between the quartiles of each bucket
    and, weighted, between the lengths. It is bounded by the steps down to an
    empty text's quartiles.
    """
    (size_a, codes_a), (size_b, codes_b) = parse(one), parse(other)
    steps = abs(size_a - size_b)
    most = int(_DIFFERENCE[codes_a, 0].sum() + _DIFFERENCE[codes_b, 0].sum())
    if not most:
        return float(steps == 0)
    score = int(_DIFFERENCE[codes_a, codes_b].sum()) + LENGTH_WEIGHT * steps
    return 1.0 - min(score, most) / most


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every whole text, without any shuffle.

    A null text counts as an empty one. Equal texts have equal fingerprints.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([digest(text.encode()) for text in texts(part.column(1))], pa.string())
        return pa.RecordBatch.from_arrays([part.column(0), found], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_column, text_column).mapInArrow(per_batch(work), "doc_id long, fingerprint string")


RESULT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_FIELDS = [field.split() for field in RESULT_SCHEMA.split(", ")]
_KINDS = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(column, _KINDS[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _compared(doc_id: int | None, text: str, own: str, following: str, next_digest: str) -> tuple:
    """A row of the result: the text against its edit and the text that follows."""
    moved = len(text) // 4
    edited = (text[: len(text) - moved] + following[:moved]).encode()
    changed = digest(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        own,
        changed,
        likeness(own, changed),
        likeness(own, next_digest),
    )


def against_next(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each text's fingerprint against that of an edit and of the next text.

    The edit replaces the last quarter of the code points by the first as many
    (or all) of the next document in ascending id order; after the last comes
    the first. Null ids come first, rows that repeat an id are ordered by their
    text, a null text counts as an empty one, a lone document follows itself.

    The texts are dealt by ranges of the id and each task goes through its
    range in order. The last text of a task needs the first of the next task
    that has any: those two texts per task are passed on beside the rows and
    met in a second, small step.
    """
    ordered = (
        id_and_text(docs, id_column, text_column)
        .repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    found = stored(ordered.mapInArrow(_walk, f"{RESULT_SCHEMA}, task int, edge string, text string"), "digests")
    rows = found.where(F.col("edge").isNull()).select(*(name for name, _ in _FIELDS))

    heads = found.where("edge = 'head'").select("task", "text", "fingerprint")
    order = Window.orderBy("task")
    all_tasks = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    linked = heads.select(
        "task", F.coalesce(F.lead("task").over(order), F.min("task").over(all_tasks)).alias("next_task")
    )
    following = heads.select(
        F.col("task").alias("next_task"),
        F.col("text").alias("following"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    tails = found.where("edge = 'tail'").select("task", "doc_id", "text", "fingerprint")
    pairs = tails.join(linked, "task").join(following, "next_task")
    wanted = pairs.select("doc_id", "text", "fingerprint", "following", "next_fingerprint")
    return rows.unionByName(wanted.mapInArrow(_meet, RESULT_SCHEMA))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    fields = [*_FIELDS, ("task", "int"), ("edge", "string"), ("text", "string")]

    def edge(kind: str, doc_id: int | None, text: str, own: str) -> tuple:
        return (doc_id, len(text), None, own, None, None, None, task, kind, text)

    held = None
    for part in slices(batches):
        rows = []
        for doc_id, text in zip(part.column(0).to_pylist(), texts(part.column(1)), strict=True):
            own = digest(text.encode())
            if held is None:
                rows.append(edge("head", doc_id, text, own))
            else:
                rows.append((*_compared(*held, text, own), None, None, None))
            held = (doc_id, text, own)
        yield _batch(rows, fields)
    if held is not None:
        yield _batch([edge("tail", *held)], fields)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 16):
        columns = [column.to_pylist() for column in part.columns]
        yield _batch([_compared(*row) for row in zip(*columns, strict=True)], _FIELDS)
