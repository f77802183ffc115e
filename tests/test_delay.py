import numpy as np
import pytest
from pyspark.sql import functions as F

from streamwin.operators import adaptive_sliding, delay_minutes, delay_stats, estimate_delay
from streamwin.schema import EVENT_SCHEMA

NOW = "2024-03-02 00:00:00"
NOW_SECONDS = 1_709_337_600


def events_late_by(spark, delays):
    rows = spark.createDataFrame([(float(d),) for d in delays], "delay double")
    return rows.select(F.timestamp_micros(((NOW_SECONDS - F.col("delay")) * 1_000_000).cast("bigint")).alias("event_time"))


RNG = np.random.default_rng(5)


@pytest.mark.parametrize(
    "delays",
    [
        [7],
        [3, 9],
        [60] * 50,
        [0, 0, 0, 1],
        list(range(0, 20_000, 7)),
        [10] * 19 + [500_000],
        [10] * 20 + [500_000],
        [3599] * 95 + [3600] * 6,
        list(RNG.integers(-5000, 100_000, 1000)),
        list((RNG.pareto(1.2, 3000) * 60).astype(int)),
    ],
)
def test_exact_statistics(spark, delays):
    row = delay_stats(events_late_by(spark, delays), as_of=NOW).first()
    assert row.max_delay_s == max(delays)
    assert row.avg_delay_s == pytest.approx(np.mean(delays), rel=1e-12)
    assert row.p95_delay_s == pytest.approx(np.percentile(delays, 95), rel=1e-12)


def test_statistics_agree_with_the_builtin_percentile(spark):
    events = events_late_by(spark, RNG.integers(0, 40_000, 2000))
    builtin = events.select(F.expr(f"percentile({NOW_SECONDS} - unix_timestamp(event_time), 0.95)")).first()[0]
    assert delay_stats(events, as_of=NOW).first().p95_delay_s == pytest.approx(builtin, rel=1e-15)


def test_missing_times_are_left_out_and_nothing_gives_nulls(spark):
    gone = spark.createDataFrame([(None,), (None,)], "event_time timestamp")
    assert tuple(delay_stats(gone, as_of=NOW).collect()[0]) == (None, None, None)
    assert delay_stats(events_late_by(spark, [5]).unionByName(gone), as_of=NOW).first().avg_delay_s == 5.0


def test_approximate_statistics(spark):
    row = delay_stats(events_late_by(spark, range(10_000)), as_of=NOW, approximate=True, suffix="ms").first()
    assert row.max_delay_ms == 9999
    assert row.p95_delay_ms == pytest.approx(9500, abs=5)


@pytest.mark.parametrize(
    "p95, options, minutes",
    [
        (None, {}, 6),
        (0.0, {}, 6),
        (10.0, {}, 1),
        (299.9, {}, 5),
        (300.0, {}, 6),
        (600.0, {}, 12),
        (1499.0, {}, 29),
        (99_999.0, {}, 30),
        (600.0, {"max_delay": "10 minutes"}, 10),
        (60.0, {"min_delay": "30 seconds"}, 1),
        (60.0, {"min_delay": "2 hours", "max_delay": "3 hours"}, 120),
        (2000.0, {"unit_compat": True}, 1),
        (49_999.0, {"unit_compat": True, "min_delay": "3 minutes"}, 3),
        (600_000.0, {"unit_compat": True}, 12),
        (None, {"unit_compat": True}, 6),
    ],
)
def test_delay_minutes(spark, p95, options, minutes):
    row = spark.createDataFrame([(p95,)], "p95 double").select(delay_minutes(F.col("p95"), **options)).first()
    assert row[0] == minutes


def test_estimate(spark):
    assert estimate_delay(events_late_by(spark, [600] * 100), as_of=NOW) == "12 minutes"
    assert estimate_delay(events_late_by(spark, [600] * 100), as_of=NOW, unit_compat=True) == "1 minutes"
    assert estimate_delay(events_late_by(spark, [600] * 100).limit(0), as_of=NOW) == "6 minutes"


def test_the_default_clock_is_now(spark):
    assert estimate_delay(events_late_by(spark, [600])) == "30 minutes"


def test_adaptive_windows_carry_their_delay(trades):
    rows = adaptive_sliding(trades(("23:50",)), as_of=NOW)
    assert {r.watermark_delay for r in rows.collect()} == {"12 minutes"}
    assert rows.count() == 5


def test_a_stream_needs_history(spark, tmp_path, trades):
    stream = spark.readStream.schema(EVENT_SCHEMA).json(str(tmp_path))
    with pytest.raises(ValueError):
        adaptive_sliding(stream)
    result = adaptive_sliding(stream, history=trades(("23:50",)), as_of=NOW)
    assert result.isStreaming
    assert "12 minutes" in result._jdf.queryExecution().toString()


def test_counts_of_parts_give_the_statistics_of_all(spark, trades):
    from streamwin.operators import counted_delay_stats, delay_stats, estimate_delay, estimate_delay_of_counts, second_counts

    parts = [
        trades(*[(f"12:{m:02d}:{m % 7:02d}", "u", 1.0, 1) for m in range(start, 60, 7)], (None, "u", 1.0, 1))
        for start in range(7)
    ]
    counts = None
    for part in parts:
        fresh = second_counts(part)
        counts = fresh if counts is None else counts.unionByName(fresh)
    added = counts.groupBy("second").sum("n").withColumnRenamed("sum(n)", "n")
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    for as_of in ("2024-03-01 13:00:00", "2024-03-01 12:30:00"):
        assert counted_delay_stats(added, as_of=as_of).collect() == delay_stats(everything, as_of=as_of).collect()
        assert estimate_delay_of_counts(added, as_of=as_of) == estimate_delay(everything, as_of=as_of)
    empty = second_counts(trades((None, "u", 1.0, 1)))
    assert estimate_delay_of_counts(empty, as_of="2024-03-01 13:00:00") == "6 minutes"


def test_the_label_of_a_batch_starts_no_job(spark, trades):
    from streamwin.operators import adaptive_sliding

    events = trades(("12:00", "u", 1.0, 1), ("12:30", "u", 1.0, 1))
    spark.sparkContext.setJobGroup("label", "building the plan")
    built = adaptive_sliding(events, as_of="2024-03-01 13:00:00")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("label")
    assert {row.watermark_delay for row in built.collect()} == {"30 minutes"}
    spark.sparkContext.setJobGroup("", "")
