"""Timing of window plans, as metric samples for the roll-ups."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..streaming.progress import progress_table


def measure(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], runs: int = 5, clear_cache: bool = True
) -> list[tuple]:
    """Build and run a plan several times; samples of seconds and output rows per run.

    Every column is computed and thrown away. A plain count would let the
    optimizer drop the aggregates and time something else.
    """
    samples: list[tuple] = []
    for _ in range(runs):
        if clear_cache:
            spark.catalog.clearCache()
        seen = Observation()
        at = datetime.now(timezone.utc)
        begin = time.perf_counter()
        build().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - begin
        samples.append(("latency", at, name, seconds, None))
        samples.append(("records", at, name, float(seen.get["rows"]), None))
    return samples


def measure_all(spark: SparkSession, plans: dict[str, Callable[[], DataFrame]], runs: int = 5) -> DataFrame:
    """Samples of several plans in one table, for ``run_summary`` and ``compare``."""
    samples = [sample for name, build in plans.items() for sample in measure(spark, name, build, runs)]
    return progress_table(spark, samples)
