"""All registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_messages, queries_metrics, queries_streams, queries_windows

_PARTS = (queries_windows, queries_messages, queries_streams, queries_metrics)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(query) for part in _PARTS for name, query in part.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}


def _in_utc(query):
    """The tables hold zone-less UTC times, so the session reads them as UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    return run
