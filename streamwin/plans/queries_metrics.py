"""Registered queries over a metrics table derived from all events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as m
from ..sources import read_metrics, write_metrics
from .queries_windows import event_table, zoneless
from .scratch import scratch_folder


def samples_of(spark: SparkSession, folder: str) -> DataFrame:
    """Four samples per event, with its type as the window type.

    The readings are whole numbers (cents, ``k`` and the user's number), which
    add up exactly in any order.
    """
    events = event_table(spark, folder)

    def sample(metric: str, value, label):
        return F.struct(F.lit(metric).alias("metric"), value.alias("value"), label.alias("label"))

    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    samples = F.array(
        sample("latency", F.round(F.col("value") * 100), none),
        sample("throughput", F.get_json_object("props", "$.k").cast("double"), none),
        sample("memory", F.col("user_id").cast("double"), none),
        sample("watermark_delays", number, F.concat(F.col("user_id").cast("string"), F.lit(" minutes"))),
    )
    return events.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("window_type"),
        F.inline(samples),
    )


def _over_samples(build):
    return lambda spark, folder: zoneless(build(samples_of(spark, folder)))


def _runs(samples: DataFrame) -> DataFrame:
    """The same samples as timed runs: the throughput reading counts records."""
    metric = F.when(F.col("metric") == "throughput", "records").otherwise(F.col("metric"))
    return samples.withColumn("metric", metric)


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_folder(spark, "metrics")
    samples = samples_of(spark, folder)
    write_metrics(samples.filter("metric = 'latency'"), place, "20250101_000000")
    write_metrics(samples, place, "20250102_000000")
    return zoneless(read_metrics(spark, place))


def _means(samples: DataFrame) -> DataFrame:
    return m.mean_values(samples, "latency")


QUERIES = {
    "metrics_window_types": _over_samples(m.window_types),
    "metrics_latest": _over_samples(lambda s: m.latest_values(s, tie_break=["event_id"])),
    "metrics_mean": _over_samples(_means),
    "metrics_compare": _over_samples(m.compare),
    "metrics_last_update": _over_samples(m.last_update),
    "metrics_series": _over_samples(lambda s: m.series(s, "latency")),
    "metrics_run_summary": _over_samples(lambda s: m.run_summary(_runs(s))),
    "metrics_run_rates": _over_samples(lambda s: m.run_rates(_runs(s))),
    "metrics_csv_round_trip": _csv_round_trip,
}

_CENTS_SQL = "round(value * 100)"
_K_SQL = "cast(json_extract_string(props, '$.k') as double)"
_USER_SQL = "cast(user_id as double)"
_METRIC_ROWS = (
    f"select event_id, ts, event_type, 'latency' as metric, {_CENTS_SQL} as value, null as label from events "
    f"union all select event_id, ts, event_type, 'throughput', {_K_SQL}, null from events "
    f"union all select event_id, ts, event_type, 'memory', {_USER_SQL}, null from events"
)

ORACLES = {
    "metrics_window_types": "select distinct event_type as window_type from events",
    "metrics_latest": (
        "select event_type as window_type, metric, arg_max(value, row(ts, event_id)) as value "
        f"from ({_METRIC_ROWS}) group by event_type, metric"
    ),
    "metrics_mean": f"select event_type as window_type, avg({_CENTS_SQL}) as avg from events group by event_type",
    "metrics_compare": (
        f"select event_type as window_type, avg({_CENTS_SQL}) as avg_latency, avg({_K_SQL}) as avg_throughput "
        "from events group by event_type"
    ),
    "metrics_last_update": "select max(ts) as last_update from events",
    "metrics_series": f"select event_type as window_type, ts as timestamp, {_CENTS_SQL} as value from events",
    "metrics_run_summary": (
        f"select event_type as window_type, avg({_CENTS_SQL}) as avg_latency, min({_CENTS_SQL}) as min_latency, "
        f"max({_CENTS_SQL}) as max_latency, sum({_K_SQL}) / nullif(sum({_CENTS_SQL}), 0) as avg_throughput, "
        f"avg({_USER_SQL}) as avg_memory, max({_USER_SQL}) as peak_memory from events group by event_type"
    ),
    "metrics_run_rates": (
        f"select event_type as window_type, ts as timestamp, sum({_K_SQL}) / nullif(sum({_CENTS_SQL}), 0) as throughput "
        "from events group by event_type, ts"
    ),
    "metrics_csv_round_trip": (
        f"select metric, ts as timestamp, event_type as window_type, value, label from ({_METRIC_ROWS}) "
        "union all select 'watermark_delays', ts, event_type, null, cast(user_id as varchar) || ' minutes' from events"
    ),
}
