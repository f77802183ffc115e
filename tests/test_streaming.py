"""Streams fed one JSON file per micro-batch."""

import json
import os
from pathlib import Path

import pytest
from conftest import at, clock
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamwin.functions import COUNT_AND_AVERAGE, COUNT_ONLY
from streamwin.operators import (
    adaptive_sliding,
    hybrid,
    keyed_multi_granularity,
    keyed_session,
    keyed_sliding,
    keyed_tumbling,
    metrics,
    multi_granularity,
    session,
    sliding,
    static_sliding,
    tumbling,
)
from streamwin.plans import adaptive_cycle, live_samples, start_live, start_symbol_strategies
from streamwin.schema import EVENT_SCHEMA
from streamwin.sources import encode, read_metrics, stream_events, write_metrics
from streamwin.streaming import (
    AVAILABLE_NOW,
    OUTPUT_MODES,
    checkpointed_writer,
    console_writer,
    finish,
    jdbc_batch_writer,
    late_rows,
    memory_writer,
    progress_samples,
    session_conf,
    progress_table,
    run_for,
    set_checkpoint_root,
    start_at_scale,
    start_files,
    start_jdbc,
)

LATE_CASE = [["12:00", "12:30"], ["12:31"], ["12:01", "12:27", "12:40"]]


class Feed:
    """A folder of event files that a stream takes in the order they were added."""

    def __init__(self, spark, folder: Path):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def add(self, clocks, user="u", symbol="AAPL"):
        lines = [
            json.dumps(
                {
                    "event_time": at(c).isoformat(),
                    "symbol": symbol,
                    "price": 2.5,
                    "volume": 4,
                    "user_id": user,
                    "trade_type": "BUY",
                }
            )
            for c in clocks
        ]
        path = self.folder / f"part-{self.files:03d}.json"
        path.write_text("\n".join(lines) + "\n")
        # The source orders files by change time; give each its own second.
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self

    def stream(self, per_trigger=1):
        return stream_events(self.spark, str(self.folder), EVENT_SCHEMA, max_files_per_trigger=per_trigger)


@pytest.fixture
def feed(spark, tmp_path):
    def make(files, name="events"):
        made = Feed(spark, tmp_path / name)
        for clocks in files:
            made.add(clocks)
        return made

    return make


def run(result, place, name="result"):
    query = start_files(
        result, name, output_root=f"{place}/out", checkpoint_root=f"{place}/cp", trigger=AVAILABLE_NOW
    )
    return finish(query)


def stored(spark, result, place, name="result"):
    return spark.read.schema(result.schema).parquet(f"{place}/out/{name}").collect()


def starts(rows):
    return sorted((clock(r.window_start), r.event_count) for r in rows)


@pytest.mark.parametrize(
    "delay, emitted, dropped",
    [
        ("5 minutes", [("12:00", 1), ("12:25", 1), ("12:30", 2)], 1),
        ("30 minutes", [("12:00", 2)], 0),
    ],
)
def test_late_rows(spark, feed, tmp_path, delay, emitted, dropped):
    result = tumbling(feed(LATE_CASE).stream(), delay=delay, measures=COUNT_ONLY)
    query = run(result, tmp_path)
    assert starts(stored(spark, result, tmp_path)) == emitted
    assert late_rows(query) == dropped


@pytest.mark.parametrize("single_scan", [None, False, True])
def test_lateness_of_granularities(spark, feed, tmp_path, single_scan):
    files = [["12:08:30"], ["12:09"], ["12:01", "12:10"], ["12:40"]]
    result = multi_granularity(
        feed(files).stream(), delay="5 minutes", measures=COUNT_ONLY, single_scan=single_scan
    )
    run(result, tmp_path)
    found = {}
    for row in stored(spark, result, tmp_path):
        found.setdefault(row.granularity, []).append(row)
    assert starts(found["15 minutes"]) == [("12:00", 4)]
    assert starts(found["5 minutes"]) == [("12:00", 1), ("12:05", 2), ("12:10", 1)]
    # Judged by its own end, the window of 12:01 is closed by then.
    assert (("12:01", 1) in starts(found["1 minute"])) == bool(single_scan)


def test_granularities_share_one_state_and_one_read(spark, feed, tmp_path):
    files = [["12:00", "12:07", "12:16"], ["12:31"], ["12:40", "13:20"]]
    result = multi_granularity(feed(files).stream(), measures=COUNT_ONLY)
    query = run(result, tmp_path)
    read = [json.loads(p.json) for p in query.recentProgress]
    assert sum(batch["numInputRows"] for batch in read) == 6
    assert {len(batch["stateOperators"]) for batch in read} == {1}
    assert sum(r.event_count for r in stored(spark, result, tmp_path) if r.granularity == "15 minutes") == 5


def test_restart_on_the_same_checkpoint_keeps_the_watermark(spark, feed, tmp_path):
    source = feed(LATE_CASE)
    first = tumbling(source.stream(), delay="5 minutes", measures=COUNT_ONLY)
    query = run(first, tmp_path)
    assert query.lastProgress["eventTime"]["watermark"].startswith("2024-03-01T12:35")
    before = stored(spark, first, tmp_path)

    source.add(["12:50"])
    second = tumbling(source.stream(), delay="20 minutes", measures=COUNT_ONLY)
    query = run(second, tmp_path)
    marks = {p["eventTime"]["watermark"][11:16] for p in query.recentProgress if p["eventTime"].get("watermark")}
    assert marks == {"12:35"}
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    after = stored(spark, second, tmp_path)
    assert all(row in after for row in before)
    assert len(set(after)) == len(after)


def test_window_closes_when_the_watermark_reaches_its_end(spark, feed, tmp_path):
    result = tumbling(feed([["12:00"], ["12:10"]]).stream(), delay="5 minutes", measures=COUNT_ONLY)
    run(result, tmp_path)
    assert starts(stored(spark, result, tmp_path)) == [("12:00", 1)]


def test_a_session_grows_over_micro_batches(spark, feed, tmp_path):
    result = session(feed([["12:00"], ["12:08"], ["12:16"], ["13:30"]]).stream(), "10 minutes")
    run(result, tmp_path)
    rows = stored(spark, result, tmp_path)
    assert [(clock(r.session_start), clock(r.session_end), r.event_count, r.total_volume) for r in rows] == [
        ("12:00", "12:26", 3, 12)
    ]


BUILDS = {
    "tumbling": (tumbling, "window"),
    "sliding": (sliding, "window"),
    "static_sliding": (static_sliding, "window"),
    "keyed_tumbling": (keyed_tumbling, "window"),
    "keyed_sliding": (keyed_sliding, "window"),
    "hybrid": (hybrid, "window"),
    "hybrid_union": (lambda events: hybrid(events, shared=False), "union"),
    "multi_granularity": (multi_granularity, "union"),
    "multi_single_scan": (lambda events: multi_granularity(events, single_scan=True), "window"),
    "keyed_multi_granularity": (keyed_multi_granularity, "union"),
    "session": (session, "session"),
    "keyed_session": (keyed_session, "session"),
}


@pytest.mark.parametrize("name", BUILDS)
@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_output_modes(spark, feed, tmp_path, name, mode):
    build, kind = BUILDS[name]
    result = build(feed([["12:00"]]).stream())
    writer = checkpointed_writer(result, mode, str(tmp_path / "cp"), f"mode_{name}", AVAILABLE_NOW).format("noop")
    if mode in OUTPUT_MODES[kind]:
        finish(writer.start())
    else:
        with pytest.raises(AnalysisException):
            writer.start()


@pytest.mark.parametrize("name", BUILDS)
def test_complete_stream_equals_batch(spark, feed, name):
    """Fed in three files, the full state of a stream is the batch result."""
    source = feed([["12:00", "12:07:30", "12:03"], ["12:04", "12:31"], ["12:09", "12:55"]], name)
    build, _ = BUILDS[name]
    table = f"complete_{name}"
    finish(memory_writer(build(source.stream()), table, "complete").trigger(availableNow=True).start())
    batch = build(spark.read.schema(EVENT_SCHEMA).json(str(source.folder)))
    stream = spark.table(table)
    assert stream.columns == batch.columns
    assert sorted(map(repr, stream.collect())) == sorted(map(repr, batch.collect()))


def test_a_shared_hybrid_reads_its_source_once(feed, tmp_path):
    files = [["12:00", "12:30"]]
    once = run(hybrid(feed(files, "a").stream()), tmp_path, "once")
    twice = run(hybrid(feed(files, "b").stream(), shared=False), tmp_path, "twice")
    rows = [sum(p["numInputRows"] for p in q.recentProgress) for q in (once, twice)]
    assert rows == [2, 4]
    assert len(once.recentProgress[0]["stateOperators"]) == 1


def test_memory_table(spark, feed):
    result = tumbling(feed([["12:00", "12:01"]]).stream(), "1 minute", delay="1 minute", measures=COUNT_AND_AVERAGE)
    finish(memory_writer(result, "memory_table", "complete").trigger(availableNow=True).start())
    assert starts(spark.table("memory_table").collect()) == [("12:00", 1), ("12:01", 1)]


def test_console(feed):
    """The JVM prints past Python's capture, so the progress tells what was printed."""
    result = tumbling(feed([["12:00"]]).stream(), measures=COUNT_ONLY)
    query = finish(console_writer(result).trigger(availableNow=True).start())
    assert query.name == "console_output"
    assert "ConsoleTable" in query.recentProgress[0]["sink"]["description"]
    assert query.recentProgress[0]["sink"]["numOutputRows"] == 1


def test_the_writer_builder_names_and_places_its_query(spark, feed, tmp_path):
    result = tumbling(feed([["12:00"]]).stream())
    query = checkpointed_writer(result, "update", str(tmp_path / "cp"), "named", "1 second").format("noop").start()
    try:
        assert query.name == "named"
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert (tmp_path / "cp" / "offsets" / "0").exists()


def test_progress_keeps_every_batch(spark, feed, tmp_path):
    """Six batches and more, of which the query itself remembers two."""
    result = tumbling(feed([*LATE_CASE, ["12:41"], ["12:02"], ["12:50"], ["12:03"]]).stream(), measures=COUNT_ONLY)
    with session_conf(spark, {"spark.sql.streaming.numRecentProgressUpdates": "2"}):
        query = run(result, tmp_path)
    assert len(query.recentProgress) <= 2
    assert late_rows(query) == 3
    samples = progress_samples(query, "w")
    assert sum(value for name, _, _, value, _ in samples if name == "input_rows") == 10
    elapsed = [value for name, _, _, value, _ in samples if name == "elapsed"]
    assert elapsed == sorted(elapsed) and len(elapsed) >= 7
    took = [value for name, _, _, value, _ in samples if name == "latency"]
    assert elapsed[-1] >= sum(took[:-1]) * 0.9


def test_writers_use_the_session_root(spark, feed, tmp_path):
    result = tumbling(feed([["12:00"]]).stream(), measures=COUNT_ONLY)
    with pytest.raises(ValueError, match="checkpoint"):
        checkpointed_writer(result, query_name="unrooted")
    with session_conf(spark, {"spark.sql.streaming.checkpointLocation": f"{tmp_path}/root"}):
        with pytest.raises(ValueError, match="checkpoint"):
            checkpointed_writer(result)
        finish(checkpointed_writer(result, query_name="below", trigger=AVAILABLE_NOW).format("noop").start())
    assert (tmp_path / "root" / "below" / "commits").exists()


def test_jdbc_needs_a_word_on_replays():
    with pytest.raises(ValueError, match="at_least_once"):
        jdbc_batch_writer({}, "t")


def test_checkpoint_root(spark, feed, tmp_path):
    before = spark.conf.get("spark.sql.streaming.checkpointLocation", None)
    try:
        assert set_checkpoint_root(spark, str(tmp_path / "root")) == str(tmp_path / "root")
        writer = tumbling(feed([["12:00"]]).stream()).writeStream.outputMode("update").format("noop")
        finish(writer.queryName("rooted").trigger(availableNow=True).start())
        assert (tmp_path / "root" / "rooted" / "commits").exists()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.checkpointLocation")


def test_settings_for_scale_last_only_for_the_start(spark, feed, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    result = session(feed([["12:00", "12:01"], ["13:30"]]).stream(), "10 minutes")
    writer = checkpointed_writer(result, "append", str(tmp_path / "cp"), "scaled", AVAILABLE_NOW)
    query = finish(start_at_scale(spark, writer.format("parquet").option("path", str(tmp_path / "out"))))
    assert spark.conf.get(name) == before
    assert "rocksdbPutCount" in " ".join(query.recentProgress[0]["stateOperators"][0]["customMetrics"])
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r.event_count for r in rows] == [2]


def test_events_of_a_session_merge_before_the_shuffle(feed, tmp_path, capsys):
    query = run(session(feed([["12:00", "12:01"]]).stream()), tmp_path)
    query.explain()
    plan = capsys.readouterr().out
    before, after = plan[plan.index("Exchange") :], plan[: plan.index("Exchange")]
    assert before.count("MergingSessions") == after.count("MergingSessions") == 1


def test_state_partitions_of_one_query(spark, feed, tmp_path):
    result = tumbling(feed([["12:00"]]).stream(), measures=COUNT_ONLY)
    query = finish(
        start_files(
            result,
            output_root=f"{tmp_path}/out",
            checkpoint_root=f"{tmp_path}/cp",
            trigger=AVAILABLE_NOW,
            state_partitions=3,
        )
    )
    assert query.recentProgress[0]["stateOperators"][0]["numStateStoreInstances"] == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"


class Table:
    """Stands in for a database table that batches are appended to."""

    def __init__(self):
        self.rows, self.targets = [], []

    def save(self, batch, options):
        self.targets.append(options)
        self.rows += batch.collect()

    def clear(self, table, batch_id):
        self.rows = [row for row in self.rows if row.batch_id != batch_id]


def test_jdbc_sink_appends_each_batch_to_its_table(feed, tmp_path):
    table = Table()
    result = keyed_tumbling(feed(LATE_CASE).stream())
    options = {"url": "jdbc:postgresql://db/stream", "user": "writer"}
    query = start_jdbc(
        result, "session", options=options, checkpoint_root=str(tmp_path), trigger=AVAILABLE_NOW, save=table.save,
        at_least_once=True,
    )
    finish(query)
    assert table.targets[0] == {**options, "dbtable": "session_aggregations"}
    assert starts(table.rows) == [("12:00", 1), ("12:26", 1), ("12:30", 2)]
    assert {type(row.batch_id) for row in table.rows} == {int}


def test_a_batch_handed_over_again_is_stored_once(spark):
    table = Table()
    write = jdbc_batch_writer({}, "t", clear_batch=table.clear, save=table.save)
    for batch_id in (0, 1, 1, 1):
        write(spark.range(3), batch_id)
    assert sorted((row.batch_id, row.id) for row in table.rows) == [(b, i) for b in (0, 1) for i in range(3)]


def test_a_table_without_batch_numbers(spark):
    table = Table()
    jdbc_batch_writer({}, "t", save=table.save, batch_column=None, at_least_once=True)(spark.range(2), 7)
    assert [row.asDict() for row in table.rows] == [{"id": 0}, {"id": 1}]


def test_jdbc_options_reach_the_writer(spark, monkeypatch):
    """Without a driver on the class path the write fails at loading it, which shows the options arrive."""
    write = jdbc_batch_writer({"url": "jdbc:postgresql://h/db", "driver": "org.postgresql.Driver"}, "t", at_least_once=True)
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        write(spark.range(1), 0)


def test_live_strategies_run_side_by_side(spark, feed, trades, tmp_path):
    source = feed([["12:00", "12:07"], ["12:40"]])

    def to_memory(writer, name):
        return writer.format("memory")

    queries = start_live(
        spark,
        source.stream(),
        checkpoint_root=str(tmp_path),
        history=trades(("12:00",)),
        trigger=AVAILABLE_NOW,
        sink=to_memory,
    )
    assert list(queries) == ["session", "hybrid", "multi", "adaptive"]
    for query in queries.values():
        finish(query)
    assert spark.table("session_window").count() == 1
    assert {r.window_type for r in spark.table("hybrid_window").collect()} == {"tumbling", "sliding"}
    assert {r.granularity for r in spark.table("multi_window").collect()} == {"1 minute", "5 minutes", "15 minutes"}
    assert {r.watermark_delay for r in spark.table("adaptive_window").collect()} == {"15 minutes"}

    samples = progress_table(spark, live_samples(queries, "15 minutes"))
    write_metrics(samples, f"{tmp_path}/metrics", "20250101_120000")
    back = read_metrics(spark, f"{tmp_path}/metrics")
    assert back.count() == samples.count()
    labels = back.filter("metric = 'watermark_delays'").select("window_type", "label").distinct()
    assert {tuple(row) for row in labels.collect()} == {
        ("Session Window", "10 minutes"),
        ("Hybrid Window", "5 minutes"),
        ("Multi-Granularity Window", "30 minutes"),
        ("Adaptive Window", "15 minutes"),
    }
    rows = {r.window_type: r.rows for r in back.filter("metric = 'input_rows'").groupBy("window_type").agg(F.sum("value").alias("rows")).collect()}
    assert rows == {"Session Window": 3, "Hybrid Window": 3, "Multi-Granularity Window": 3, "Adaptive Window": 3}


def test_adaptive_cycles_estimate_anew_and_go_on(spark, feed, trades, tmp_path):
    """Ten minutes of lateness give 12, a quarter of an hour is cut to 15."""
    source, place = feed([["12:00"], ["12:40"]]), {"output_root": f"{tmp_path}/out", "checkpoint_root": f"{tmp_path}/cp"}

    def cycle(latest):
        return adaptive_cycle(source.stream(), trades((latest,)), as_of="2024-03-01 13:00:00", **place)

    query = cycle("12:50")
    assert query.lastProgress["eventTime"]["watermark"].startswith("2024-03-01T12:28")
    source.add(["12:30"]).add(["13:30"])
    query = cycle("12:30")
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert late_rows(query) == 0
    rows = spark.read.parquet(f"{tmp_path}/out/adaptive").collect()
    assert len(rows) == 15
    found = {(clock(r.window_start), r.watermark_delay) for r in rows}
    assert ("12:00", "12 minutes") in found and ("12:40", "15 minutes") in found


def test_symbol_strategies_decode_and_start(spark, feed, tmp_path):
    messages = encode(feed([["12:00", "12:01"], ["13:40"]]).stream())
    tables = {}

    def to_table(result, name):
        tables[name] = Table()
        return start_jdbc(
            result,
            name,
            options={},
            checkpoint_root=str(tmp_path),
            trigger=AVAILABLE_NOW,
            save=tables[name].save,
            clear_batch=tables[name].clear,
        )

    for query in start_symbol_strategies(messages, to_table).values():
        finish(query)
    assert starts(tables["session"].rows) == [("12:00", 2)]
    assert starts(tables["hybrid"].rows) == [("11:59", 1), ("12:00", 2), ("12:01", 1)]
    assert len(tables["multi_granularity"].rows) == 4
    assert starts(tables["adaptive"].rows) == [("12:00", 2)]
    assert {r.avg_price for t in tables.values() for r in t.rows} == {2.5}


def test_run_for_stops_every_query(spark, feed, tmp_path):
    source = feed([["12:00"]])
    queries = [
        checkpointed_writer(tumbling(source.stream()), "update", f"{tmp_path}/{n}", f"bounded_{n}", "1 second")
        .format("noop")
        .start()
        for n in range(2)
    ]
    run_for(queries, 3)
    assert not any(query.isActive for query in queries)


def test_run_for_raises_what_failed(spark, feed, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    writer = tumbling(feed([["12:00"]]).stream()).writeStream.outputMode("update").foreachBatch(fail)
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).start()
    with pytest.raises(Exception, match="sink is gone"):
        run_for([query], 30)


def test_progress_becomes_metric_samples(spark, feed, tmp_path):
    query = run(tumbling(feed(LATE_CASE).stream()), tmp_path)
    samples = progress_table(spark, progress_samples(query, "Tumbling", "5 minutes"))
    totals = {r.metric: r.total for r in samples.groupBy("metric").agg(F.sum("value").alias("total")).collect()}
    assert totals["input_rows"] == 6
    assert totals["late_rows"] == 1
    assert totals["latency"] > 0 and totals["throughput"] > 0 and totals["memory"] > 0
    assert {r.label for r in samples.filter("metric = 'watermark_delays'").collect()} == {"5 minutes"}
    assert [r.window_type for r in metrics.window_types(samples).collect()] == ["Tumbling"]
    assert metrics.latest_values(samples).count() == 3
