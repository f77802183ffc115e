"""Replaying a table as a stream: its rows in slices, one after the other, as they once arrived."""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import interval_micros
from .runs import session_conf

# Rows of a file, about. A file is read by one task, so a slice of more rows takes more files.
ROWS_A_FILE = 100_000
# Milliseconds between the file times of two slices: stores that keep whole seconds tell them apart.
_APART = 1000
# Kinds of columns left out of the hash by which rows are dealt out to files; maps have none.
_NESTED = ("array", "map", "struct", "variant")


def arrival_slice(arrival: Column, width: str) -> Column:
    """The number of the stretch of time, ``width`` long, in which a row arrived; null for a null time."""
    return F.floor(F.unix_micros(arrival) / interval_micros(width)).cast("long")


def add_slices(
    events: DataFrame, folder: str, slice_column: str, *, staged: str, files: int = 1, most_rows: int | None = None
) -> Iterator[int]:
    """Add the slices of a table to ``folder`` in their order; yields a slice's number once its files are there.

    A stream that follows the folder takes files in the order of their times.
    With one file for a slice, which is the default, a trigger of one file is one
    slice. Larger slices take more files, and a run after each slice then makes
    it one micro-batch. With ``most_rows`` a slice has no fewer files than about that
    many rows in each ask for. Rows without a number are not replayed. The table
    is read twice, to count and to write its rows once, into ``staged``; from there
    the files are moved, with times in the order of the slices. What the driver
    keeps are the slices' numbers and sizes.
    """
    sizes = _sizes(events, slice_column)
    needed = {number: max(files, _files(rows, most_rows)) for number, rows in sizes}
    spark = events.sparkSession
    _stage(events, slice_column, staged, needed, sum(needed.values()))
    first = _first_time(spark, folder, len(sizes))
    for at, (number, _) in enumerate(sizes):
        found = _data_files(spark, f"{staged}/{slice_column}={number}")
        if not _moved(spark, found, folder, number, first + at * _APART):
            _add(events, staged, folder, slice_column, number, needed[number])
        yield number


def write_slices(events: DataFrame, folder: str, slice_column: str, *, staged: str, files: int = 1) -> int:
    """All of :func:`add_slices`; how many there were."""
    return sum(1 for _ in add_slices(events, folder, slice_column, staged=staged, files=files))


def write_even_slices(
    events: DataFrame, folder: str, slice_column: str, *, staged: str, most_rows: int = ROWS_A_FILE
) -> int:
    """All slices, each in the same number of files, which is returned: a trigger of so many files is one slice.

    The largest slice sets the number. A slice with too few rows for it gets
    files without rows besides.
    """
    sizes = _sizes(events, slice_column)
    needed = [_files(rows, most_rows) for _, rows in sizes]
    spark, files, empty = events.sparkSession, max(needed, default=1), f"{staged}-empty"
    _stage(events, slice_column, staged, {number: files for number, _ in sizes}, sum(needed))
    if files > 1:
        events.drop(slice_column).limit(0).coalesce(1).write.parquet(empty)
    first = _first_time(spark, folder, len(sizes))
    for at, (number, _) in enumerate(sizes):
        found = _data_files(spark, f"{staged}/{slice_column}={number}")
        for missing in range(len(found), files):
            copied = f"{staged}-empty-{at}/part-empty-{missing}.parquet"
            _copy(spark, _data_files(spark, empty)[0], copied)
            found.append(_path(spark, copied))
        if not _moved(spark, found, folder, number, first + at * _APART):
            before = len(_data_files(spark, folder))
            _add(events, staged, folder, slice_column, number, files)
            for missing in range(len(_data_files(spark, folder)) - before, files):
                _copy(spark, _data_files(spark, empty)[0], f"{folder}/part-empty-{at}-{missing}.parquet")
    return files


def _sizes(events: DataFrame, slice_column: str) -> list[tuple[int, int]]:
    """Each slice's number and rows, in order."""
    found = events.where(F.col(slice_column).isNotNull()).groupBy(slice_column).agg(F.count("*").alias("rows"))
    return sorted((row[0], row[1]) for row in found.collect())


def _stage(events: DataFrame, slice_column: str, staged: str, files: dict[int, int], tasks: int) -> None:
    """Write the rows that have a number to a folder for each slice, in so many files unless one gets no rows.

    A row's file follows from its values, so a task that runs again deals it out as before;
    equal rows share a file.
    """
    spark, file = events.sparkSession, f"{slice_column}_file"
    numbered = events.where(F.col(slice_column).isNotNull())
    values = [name for name, kind in numbered.dtypes if name != slice_column and not kind.startswith(_NESTED)]
    if len(set(files.values())) > 1:
        counts = spark.createDataFrame(list(files.items()), f"{slice_column} long, {file} long")
        dealt = numbered.join(F.broadcast(counts), slice_column)
    else:
        dealt = numbered.withColumn(file, F.lit(max(files.values(), default=1)).cast("long"))
    dealt = dealt.withColumn(file, F.pmod(F.xxhash64(*values) if values else F.lit(0), file))
    dealt = dealt.repartition(max(1, tasks), slice_column, file)
    # A task has few files, so it keeps them open rather than sort its rows.
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "8"}):
        dealt.write.partitionBy(slice_column, file).parquet(staged)


def _files(rows: int, most_rows: int | None) -> int:
    return 1 if most_rows is None else -(-rows // most_rows)


def _first_time(spark: SparkSession, folder: str, slices: int) -> int:
    """The file time of the first of so many slices: the last is of now, and none is older than what is there."""
    there = [_file_system(spark, path).getFileStatus(path).getModificationTime() for path in _data_files(spark, folder)]
    return max([int(time.time() * 1000) - slices * _APART, *there]) + _APART


def _moved(spark: SparkSession, found: list, folder: str, number: int, moment: int) -> bool:
    """Move a slice's files to the folder under one time; false, and nothing moved, where a store sets times itself."""
    for path in found:
        system = _file_system(spark, path)
        system.setTimes(path, moment, -1)
        if system.getFileStatus(path).getModificationTime() != moment:
            return False
    system = _file_system(spark, _path(spark, folder))
    system.mkdirs(_path(spark, folder))
    for at, path in enumerate(found):
        if not system.rename(path, _path(spark, f"{folder}/part-{number}-{at}-{path.getName()}")):
            raise OSError(f"could not move {path.toString()} to {folder}")
    return True


def _add(events: DataFrame, staged: str, folder: str, slice_column: str, number: int, files: int) -> None:
    """Write a slice anew, which is then newer than those before it."""
    rows = events.drop(slice_column)
    one = events.sparkSession.read.schema(rows.schema).parquet(f"{staged}/{slice_column}={number}").select(rows.columns)
    (one.coalesce(1) if files == 1 else one.repartition(files)).write.mode("append").parquet(folder)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _data_files(spark: SparkSession, folder) -> list:
    """The files of rows below a folder."""
    path = _path(spark, folder) if isinstance(folder, str) else folder
    system, found = _file_system(spark, path), []
    for status in system.listStatus(path) if system.exists(path) else ():
        if status.isDirectory():
            found += _data_files(spark, status.getPath())
        elif status.getPath().getName().startswith("part-"):
            found.append(status.getPath())
    return found


def _copy(spark: SparkSession, path, to: str) -> None:
    goal, conf = _path(spark, to), spark._jsc.hadoopConfiguration()
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        _file_system(spark, path), path, _file_system(spark, goal), goal, False, conf
    )
