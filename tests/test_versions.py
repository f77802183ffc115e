"""Tables kept by streams in update and complete mode, and the replay of a table in slices."""

import os

import pytest
from pyspark.sql import functions as F

from streamwin.streaming import (
    VersionedTable,
    add_slices,
    arrival_slice,
    start_upserts,
    write_even_slices,
    write_slices,
)


@pytest.fixture
def rows(spark):
    return lambda **values: spark.createDataFrame(list(values.items()), "k string, v long")


@pytest.fixture
def table(rows, tmp_path):
    return VersionedTable(str(tmp_path / "table"), rows(a=1).schema, ["k"])


def content(spark, table):
    return {row["k"]: row["v"] for row in table.read(spark).collect()}


def test_a_table_without_a_commit_is_empty(spark, table):
    assert content(spark, table) == {} and table.last_commit(spark) is None
    assert table.forget(spark) == 0


def test_a_reader_sees_a_snapshot_before_or_after(spark, table, rows):
    table.put_snapshot(rows(a=1, b=2), 0)
    seen = []
    table.put_snapshot(rows(a=7), 1, lambda batch: seen.append((batch, content(spark, table))))
    assert seen == [(1, {"a": 1, "b": 2})]
    assert content(spark, table) == {"a": 7}


def test_a_reader_sees_changes_before_or_after(spark, table, rows):
    table.put_changes(rows(a=1, b=2), 0)
    seen = []
    table.put_changes(rows(b=3, c=4), 1, before_commit=lambda batch: seen.append(content(spark, table)))
    assert seen == [{"a": 1, "b": 2}]
    assert content(spark, table) == {"a": 1, "b": 3, "c": 4}


@pytest.mark.parametrize("fold_every", [1, 2, 3, 100])
def test_the_newest_row_of_a_key_stays(spark, table, rows, fold_every):
    want = {}
    for batch in range(7):
        change = {f"k{batch % 3}": batch, f"k{batch}": -batch}
        want |= change
        table.put_changes(rows(**change), batch, fold_every)
        assert content(spark, table) == want
    newest, snapshot = table.last_commit(spark)
    assert newest == 6 and (snapshot is None) == (fold_every == 100)


@pytest.mark.parametrize("fold_every", [2, 100])
def test_a_batch_handed_over_again_is_stored_once(spark, table, rows, fold_every):
    def fail(batch):
        raise OSError("lost")

    table.put_changes(rows(a=1), 0, fold_every)
    with pytest.raises(OSError):
        table.put_changes(rows(a=2, b=9), 1, fold_every, fail)
    assert content(spark, table) == {"a": 1}
    for _ in range(2):
        table.put_changes(rows(a=2, b=5), 1, fold_every)
        assert content(spark, table) == {"a": 2, "b": 5}
    table.put_changes(rows(a=3), 2, fold_every)
    assert content(spark, table) == {"a": 3, "b": 5}


def test_what_no_reader_needs_is_deleted(spark, table, rows):
    for batch in range(6):
        table.put_changes(rows(**{f"k{batch}": batch}), batch, fold_every=2)
    before = content(spark, table)
    assert table.forget(spark, keep=2) == 3
    assert content(spark, table) == before == {f"k{at}": at for at in range(6)}
    assert sorted(os.listdir(f"{table.root}/commits")) == ["batch=3", "batch=4", "batch=5"]


def test_upserts_need_keys(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="keys"):
        start_upserts(rows(a=1), VersionedTable(str(tmp_path), rows(a=1).schema), checkpoint_dir=str(tmp_path))


@pytest.mark.parametrize("files", [1, 3])
def test_slices_come_in_order_of_arrival(spark, tmp_path, files):
    events = spark.range(40).select(
        "id", F.when(F.col("id") != 7, F.timestamp_micros(F.col("id") * 60_000_000)).alias("at")
    )
    sliced = events.withColumn("slice", arrival_slice(F.col("at"), "10 minutes"))
    place, seen = str(tmp_path / "files"), []
    for number in add_slices(sliced, place, "slice", staged=str(tmp_path / "staged"), files=files):
        seen.append((number, spark.read.parquet(place).count()))
    assert seen == [(0, 9), (1, 19), (2, 29), (3, 39)]
    again = str(tmp_path / "again")
    assert write_slices(sliced, again, "slice", staged=str(tmp_path / "staged again")) == 4
    parts = sorted((p for p in os.listdir(again) if p.startswith("part")), key=lambda p: os.stat(f"{again}/{p}").st_mtime_ns)
    assert [spark.read.parquet(f"{again}/{p}").count() for p in parts] == [9, 10, 10, 10]


def test_a_large_slice_is_read_by_many_tasks(spark, tmp_path):
    """Each slice has as many files as the largest one needs, small ones too, so a trigger is still one slice."""
    sizes = {0: 900, 1: 2, 2: 350}
    events = spark.createDataFrame([(k, at) for k, size in sizes.items() for at in range(size)], "slice long, at long")
    place = str(tmp_path / "files")
    assert write_even_slices(events, place, "slice", staged=str(tmp_path / "staged"), most_rows=100) == 9
    parts = [f"{place}/{name}" for name in os.listdir(place) if name.startswith("part")]
    parts.sort(key=lambda part: os.stat(part).st_mtime_ns)
    counts = [spark.read.schema("at long").parquet(part).count() for part in parts]
    assert [sum(counts[first : first + 9]) for first in (0, 9, 18)] == list(sizes.values())
    assert len(parts) == 27 and max(counts) < 200

    stream = spark.readStream.schema("at long").option("maxFilesPerTrigger", 9).parquet(place)
    seen = {}
    writer = stream.writeStream.foreachBatch(lambda rows, batch: seen.update({batch: rows.count()}))
    writer.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert seen == sizes

    several = str(tmp_path / "several")
    list(add_slices(events, several, "slice", staged=str(tmp_path / "staged again"), most_rows=300))
    assert sum(name.startswith("part") for name in os.listdir(several)) == 3 + 1 + 2


def in_order(folder):
    """The files of rows below a folder by their times, those of one time together."""
    parts = [f"{folder}/{name}" for name in os.listdir(folder) if name.startswith("part")]
    times = sorted({os.stat(part).st_mtime_ns for part in parts})
    return [[part for part in parts if os.stat(part).st_mtime_ns == moment] for moment in times]


def test_rows_of_a_replay_are_written_once(spark, tmp_path):
    """The jobs of a replay do not grow with its slices, and a second one is newer than the first."""
    place, jobs = str(tmp_path / "files"), []
    for call, slices in enumerate((2, 9)):
        events = spark.range(180).select((F.col("id") % slices + 10 * call).alias("slice"), F.col("id").alias("at"))
        spark.sparkContext.setJobGroup(f"replay-{call}", "")
        assert write_even_slices(events, place, "slice", staged=str(tmp_path / f"staged {call}"), most_rows=1000) == 1
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"replay-{call}")))
    spark.sparkContext.setJobGroup("after", "")
    assert jobs[0] == jobs[1] > 0
    read = spark.read.schema("at long")
    sizes = [[row["at"] for row in read.parquet(*parts).orderBy("at").collect()] for parts in in_order(place)]
    assert sizes == [list(range(n, 180, s)) for s in (2, 9) for n in range(s)]


def test_a_replay_where_the_store_sets_file_times(spark, tmp_path, monkeypatch):
    """Slices are then written one after the other, each in its files."""
    monkeypatch.setattr("streamwin.streaming.replay._moved", lambda *given: False)
    sizes = {0: 500, 1: 2, 2: 250}
    events = spark.createDataFrame([(k, at) for k, size in sizes.items() for at in range(size)], "slice long, at long")
    place = str(tmp_path / "files")
    assert write_even_slices(events, place, "slice", staged=str(tmp_path / "staged"), most_rows=100) == 5
    parts = [part for some in in_order(place) for part in some]
    counts = [spark.read.schema("at long").parquet(part).count() for part in parts]
    assert [sum(counts[first : first + 5]) for first in (0, 5, 10)] == list(sizes.values()) and len(parts) == 15


def test_counts_are_added_once_for_each_batch(spark, rows, tmp_path):
    table = VersionedTable(str(tmp_path / "counts"), rows(a=1).schema, ["k"], merge="sum")
    for batch in range(5):
        for _ in range(2):
            table.put_changes(rows(a=1, **{f"k{batch % 2}": 10}), batch, fold_every=3)
    assert content(spark, table) == {"a": 5, "k0": 30, "k1": 20}
    with pytest.raises(ValueError, match="merged"):
        VersionedTable("x", rows(a=1).schema, merge="other")
