"""Roll-ups of metric samples: one narrow aggregation each, whatever the table's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metrics that carry numbers.
NUMERIC_METRICS = ("latency", "throughput", "memory")


def window_types(samples: DataFrame, metrics: Sequence[str] = NUMERIC_METRICS) -> DataFrame:
    """The window types that have a sample of any of the metrics."""
    return samples.filter(F.col("metric").isin(*metrics)).select("window_type").distinct()


def latest_values(
    samples: DataFrame, metrics: Sequence[str] = NUMERIC_METRICS, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The last value of each metric and window type; ``tie_break`` orders equal times."""
    newest = F.max_by("value", F.struct("timestamp", *tie_break)).alias("value")
    wanted = samples.filter(F.col("metric").isin(*metrics))
    return wanted.groupBy("window_type", "metric").agg(newest)


def mean_values(samples: DataFrame, metric: str) -> DataFrame:
    """The mean of one metric per window type."""
    return samples.filter(F.col("metric") == metric).groupBy("window_type").agg(F.avg("value").alias("avg"))


def compare(samples: DataFrame, left: str = "latency", right: str = "throughput") -> DataFrame:
    """The means of two metrics side by side, for every window type that has the left one.

    Both sides come from the same table, so conditional means in one
    aggregation take the place of a join. A missing right side is null.
    """
    paired = samples.filter(F.col("metric").isin(left, right)).groupBy("window_type")
    return (
        paired.agg(
            F.count(F.when(F.col("metric") == left, 1)).alias("_left"),
            F.avg(_only(left)).alias(f"avg_{left}"),
            F.avg(_only(right)).alias(f"avg_{right}"),
        )
        .filter("_left > 0")
        .drop("_left")
    )


def last_update(samples: DataFrame) -> DataFrame:
    """The time of the latest sample, as one row."""
    return samples.agg(F.max("timestamp").alias("last_update"))


def series(samples: DataFrame, metric: str) -> DataFrame:
    """One metric in time order, a series per window type."""
    rows = samples.filter(F.col("metric") == metric).select("window_type", "timestamp", "value")
    return rows.orderBy("window_type", "timestamp", "value")


def run_summary(samples: DataFrame) -> DataFrame:
    """Per window type: latency spread, records per second over all runs, memory.

    Reads the metrics ``latency`` (seconds), ``records`` and ``memory``. The
    rate is all records over all seconds, not a mean of the runs' rates.
    """
    seconds, records, memory = _only("latency"), _only("records"), _only("memory")
    return samples.groupBy("window_type").agg(
        F.avg(seconds).alias("avg_latency"),
        F.min(seconds).alias("min_latency"),
        F.max(seconds).alias("max_latency"),
        (F.sum(records) / F.nullif(F.sum(seconds), F.lit(0.0))).alias("avg_throughput"),
        F.avg(memory).alias("avg_memory"),
        F.max(memory).alias("peak_memory"),
    )


def run_rates(samples: DataFrame) -> DataFrame:
    """Records per second of every single run, told apart by its time."""
    runs = samples.filter(F.col("metric").isin("latency", "records")).groupBy("window_type", "timestamp")
    rate = F.sum(_only("records")) / F.nullif(F.sum(_only("latency")), F.lit(0.0))
    return runs.agg(rate.alias("throughput"))


def _only(metric: str) -> Column:
    return F.when(F.col("metric") == metric, F.col("value"))
