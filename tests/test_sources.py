import os
from datetime import datetime

import pytest
from conftest import at
from pyspark.sql import functions as F

from streamwin.operators import metrics
from streamwin.schema import EVENT_SCHEMA, METRIC_SCHEMA, SHORT_MESSAGE_SCHEMA, TEXT_MESSAGE_SCHEMA
from streamwin.sources import (
    decode,
    decode_text_messages,
    encode,
    events_from_rows,
    kafka_sink_options,
    kafka_source_options,
    kafka_writer,
    read_events,
    read_flat_metrics,
    read_metrics,
    stream_events,
    stream_kafka,
    stream_short_messages,
    write_events,
    write_kafka,
    write_metrics,
)
from streamwin.streaming.runs import session_conf

ROWS = [
    (at("12:00:00.123456"), "AAPL", 101.25, 10, "user_1", "BUY"),
    (at("12:00:01"), "MSFT", 0.1, 9_999_999_999, "user_2", "SELL"),
]


def test_json_files_keep_every_microsecond(spark, tmp_path):
    events = events_from_rows(spark, ROWS)
    assert events.schema == EVENT_SCHEMA
    write_events(events, f"{tmp_path}/batch_0")
    for schema in (EVENT_SCHEMA, None):
        back = read_events(spark, f"{tmp_path}/batch_0", schema).select(events.columns)
        assert dict(back.dtypes) == dict(events.dtypes)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, events.collect()))


def test_times_without_a_zone_are_read_in_the_session_zone(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_time": "2023-02-03T04:05:06.070809", "symbol": "A"}\n')
    for schema in (EVENT_SCHEMA, None):
        row = read_events(spark, str(tmp_path / "a.json"), schema).first()
        assert row.event_time == datetime(2023, 2, 3, 4, 5, 6, 70809)


def test_stream_options(spark, tmp_path):
    stream = stream_events(spark, str(tmp_path), max_files_per_trigger=3)
    assert stream.isStreaming and stream.schema.fieldNames() == EVENT_SCHEMA.fieldNames()


def test_messages_round_trip(spark):
    events = events_from_rows(spark, ROWS)
    messages = encode(events)
    assert messages.dtypes == [("value", "binary")]
    assert decode(messages, EVENT_SCHEMA).select(events.columns).collect() == events.collect()
    keyed = encode(events, key=F.col("symbol"))
    assert keyed.dtypes == [("key", "binary"), ("value", "binary")]
    assert [bytes(r.key) for r in keyed.collect()] == [b"AAPL", b"MSFT"]


def messages_of(spark, *texts):
    return spark.createDataFrame([(bytearray(text, "utf-8"),) for text in texts], "value binary")


def test_text_messages(spark):
    good = '{"event_time": "2024-03-01T12:00:00Z", "symbol": "A", "price": "1.5", "volume": "7", "user_id": "u"}'
    number = '{"symbol": "B", "price": 2.25, "volume": 8}'
    rows = decode_text_messages(messages_of(spark, good, number, '{"price": "n/a"}', "not json", "[1]", "")).collect()
    assert [(r.symbol, r.price, r.volume) for r in rows] == [
        ("A", 1.5, "7"),
        ("B", 2.25, "8"),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_short_messages_give_null_for_a_wrong_type(spark):
    rows = decode(messages_of(spark, '{"symbol": "A", "price": "x", "volume": 3}'), SHORT_MESSAGE_SCHEMA).collect()
    assert [(r.symbol, r.price, r.volume) for r in rows] == [("A", None, 3)]
    assert TEXT_MESSAGE_SCHEMA["price"].dataType.simpleString() == "string"


def test_a_message_without_value_keeps_its_row(spark):
    nothing = spark.createDataFrame([(None,), (None,)], "value binary")
    assert [tuple(row) for row in decode(nothing, SHORT_MESSAGE_SCHEMA).collect()] == [(None,) * 4] * 2


def test_kafka_options():
    assert kafka_source_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "market-events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert kafka_source_options(
        "h:1", "t", starting_offsets="latest", fail_on_data_loss=None, max_offsets_per_trigger=1000, min_partitions=64
    ) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_kafka_needs_its_connector(spark, tmp_path):
    """The connector is not installed here, so each entry point stops at looking it up."""
    stream = encode(stream_events(spark, str(tmp_path)))
    attempts = [
        lambda: stream_kafka(spark),
        lambda: stream_short_messages(spark),
        lambda: write_kafka(encode(events_from_rows(spark, ROWS))),
        lambda: kafka_writer(stream).option("checkpointLocation", str(tmp_path / "cp")).start(),
    ]
    for attempt in attempts:
        with pytest.raises(Exception, match="(?i)kafka"):
            attempt()


# --- metric samples ---------------------------------------------------------

SAMPLES = [
    ("latency", at("12:00:00.000001"), "session", 0.1, None),
    ("latency", at("12:00:10"), "session", 0.30000000000000004, None),
    ("latency", at("12:00:10"), "hybrid", 4.0, None),
    ("throughput", at("12:00:00"), "session", 7.0, None),
    ("memory", at("12:00:00"), "multi", 100.0, None),
    ("watermark_delays", at("12:00:00"), "session", None, "10 minutes"),
]


def test_metrics_written_and_read_back(spark, tmp_path):
    samples = spark.createDataFrame(SAMPLES, METRIC_SCHEMA)
    place = str(tmp_path / "metrics")
    older = samples.filter("metric = 'latency'").withColumn("value", F.lit(-1.0))
    write_metrics(older, place, "20250101_000000")
    write_metrics(older, place, "20250102_000000")
    write_metrics(samples, place, "20250102_000000")
    assert sorted(map(repr, read_metrics(spark, place).collect())) == sorted(map(repr, samples.collect()))
    write_metrics(older, place, "20250103_000000")
    latest = {r.metric: r.n for r in read_metrics(spark, place).groupBy("metric").agg(F.count("*").alias("n")).collect()}
    assert latest == {"latency": 3, "throughput": 1, "memory": 1, "watermark_delays": 1}


def test_metric_reads_list_the_latest_runs_only(spark, tmp_path):
    samples = spark.createDataFrame(SAMPLES, METRIC_SCHEMA)
    place = str(tmp_path / "metrics")
    seen = set()
    for day in range(1, 6):
        write_metrics(samples, place, f"2025010{day}_000000", splits=2)
        files = read_metrics(spark, place).inputFiles()
        assert all(f"run=2025010{day}_" in file for file in files)
        seen.add(len(files))
    assert len(seen) == 1
    write_metrics(samples.withColumn("value", F.lit(-1.0)), place, "20240101_000000")
    assert sorted(map(repr, read_metrics(spark, place).collect())) == sorted(map(repr, samples.collect()))
    assert [name for name in os.listdir(place) if name.startswith("_latest")] == ["_latest.json"]
    os.remove(f"{place}/_latest.json")
    assert read_metrics(spark, place).count() == len(SAMPLES)
    assert all("run=20250105_" in file for file in read_metrics(spark, place).inputFiles())


def test_run_is_not_seen_before_its_latest_file(spark, tmp_path, monkeypatch):
    from streamwin.sources import metric_files

    samples = spark.createDataFrame(SAMPLES, METRIC_SCHEMA)
    place = str(tmp_path / "metrics")
    write_metrics(samples, place, "20250101_000000")

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(metric_files, "replace_text", crash)
        with pytest.raises(OSError, match="lost"):
            write_metrics(samples.limit(1), place, "20250102_000000")
    assert read_metrics(spark, place).count() == len(SAMPLES)
    assert all("run=20250101_" in file for file in read_metrics(spark, place).inputFiles())
    write_metrics(samples.limit(1), place, "20250102_000000")
    assert read_metrics(spark, place).filter("metric = 'latency'").count() == 1


def test_samples_of_one_metric_are_written_by_several_tasks(spark, tmp_path):
    samples = spark.range(2000).selectExpr(
        "'latency' as metric", "timestamp_seconds(id) as timestamp", "'w' as window_type",
        "cast(id as double) as value", "cast(null as string) as label",
    )
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):  # Small ones are joined.
        write_metrics(samples, str(tmp_path / "m"), "1:a/b", splits=4)
    back = read_metrics(spark, str(tmp_path / "m"))
    assert back.agg(F.sum("value")).first()[0] == sum(range(2000)) and back.count() == 2000
    assert 1 < len(back.inputFiles()) <= 4
    write_metrics(samples.limit(1), str(tmp_path / "m"), "1:a")
    assert read_metrics(spark, str(tmp_path / "m")).count() == 2000


def test_no_metric_runs(spark, tmp_path):
    assert read_metrics(spark, str(tmp_path / "none")).count() == 0
    write_metrics(spark.createDataFrame([], METRIC_SCHEMA), str(tmp_path / "m"), "1")
    assert read_metrics(spark, str(tmp_path / "m")).collect() == []


def test_flat_metric_files_take_the_newest_of_each(spark, tmp_path):
    def file(name, text, changed):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (changed, changed))

    head = "timestamp,window_type,value\n"
    file("latency_20230203_040000.csv", head + "2023-02-03T04:05:06.070809,Session Window,0.5\n", 1_000_000)
    file("latency_20230203_090000.csv", head + "2023-02-03T08:09:10.111213,Tumbling Window,7.25\n", 2_000_000)
    file("throughput_20230203_090000.csv", head + "2023-02-03T08:09:10.111213,Tumbling Window,0.25\n", 1_500_000)
    file("throughput_20250101_000000.csv", head + "2023-02-03T08:09:10,Tumbling Window,9\n", 1_400_000)
    file("watermark_delays_1.csv", "timestamp,window_type,watermark_delay\n2023-02-03T08:09:10,Tumbling Window,10 minutes\n", 1)
    file("notes_1.csv", head, 3_000_000)
    rows = read_flat_metrics(spark, str(tmp_path)).orderBy("metric").collect()
    assert [(r.metric, r.window_type, r.value, r.label) for r in rows] == [
        ("latency", "Tumbling Window", 7.25, None),
        ("throughput", "Tumbling Window", 0.25, None),
        ("watermark_delays", "Tumbling Window", None, "10 minutes"),
    ]
    assert rows[0].timestamp == datetime(2023, 2, 3, 8, 9, 10, 111213)


def test_no_metrics(spark, tmp_path):
    assert read_flat_metrics(spark, str(tmp_path)).count() == 0


def test_roll_ups_by_hand(spark):
    samples = spark.createDataFrame(SAMPLES, METRIC_SCHEMA)
    assert {r.window_type for r in metrics.window_types(samples).collect()} == {"session", "hybrid", "multi"}
    latest = {(r.window_type, r.metric): r.value for r in metrics.latest_values(samples).collect()}
    assert latest[("session", "latency")] == 0.30000000000000004
    assert len(latest) == 4
    pairs = {r.window_type: (r.avg_latency, r.avg_throughput) for r in metrics.compare(samples).collect()}
    assert pairs == {"session": (pytest.approx(0.2), 7.0), "hybrid": (4.0, None)}
    means = {r.window_type: r.avg for r in metrics.mean_values(samples, "memory").collect()}
    assert means == {"multi": 100.0}
    assert metrics.last_update(samples).first().last_update == datetime(2024, 3, 1, 12, 0, 10)
    ordered = [(r.window_type, r.value) for r in metrics.series(samples, "latency").collect()]
    assert ordered == [("hybrid", 4.0), ("session", 0.1), ("session", 0.30000000000000004)]


def test_summary_of_runs(spark):
    runs = [
        (metric, at(f"12:0{n}"), "w", value, None)
        for n, readings in enumerate([(2.0, 100.0, 50.0), (1.0, 100.0, 70.0)])
        for metric, value in zip(("latency", "records", "memory"), readings)
    ]
    samples = spark.createDataFrame(runs, METRIC_SCHEMA)
    row = metrics.run_summary(samples).first()
    assert tuple(row) == ("w", 1.5, 1.0, 2.0, pytest.approx(200 / 3), 60.0, 70.0)
    assert sorted(r.throughput for r in metrics.run_rates(samples).collect()) == [50.0, 100.0]


def test_metrics_keep_names_and_both_readings(spark, tmp_path):
    names = ["late rows", "p95:ms", "01", "a/b%20", "ü=x"]
    samples = [(name, at("12:00"), "w", 1.5, "text") for name in names]
    samples += [("latency", at("12:00"), "w", None, "only text"), ("latency", at("12:01"), "w", 2.0, None)]
    write_metrics(spark.createDataFrame(samples, METRIC_SCHEMA), str(tmp_path / "m"), "20230101_000000")
    write_metrics(spark.createDataFrame(samples[:2], METRIC_SCHEMA), str(tmp_path / "m"), "20230102_000000")
    back = read_metrics(spark, str(tmp_path / "m")).collect()
    assert sorted((r.metric, r.value or 0.0, r.label or "") for r in back) == sorted(
        (name, value or 0.0, label or "") for name, _, _, value, label in samples
    )
