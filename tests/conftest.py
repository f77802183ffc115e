from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from streamwin.schema import EVENT_SCHEMA  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("streamwin-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(clock: str, day: str = "2024-03-01") -> datetime:
    """A time of day in UTC, such as ``12:08:30``."""
    text = clock if clock.count(":") == 2 else f"{clock}:00"
    return datetime.fromisoformat(f"{day}T{text}+00:00").astimezone(timezone.utc)


def clock(stamp: datetime) -> str:
    return stamp.strftime("%H:%M")


@pytest.fixture
def trades(spark):
    """Events from ``(time, user, price, volume)`` with missing parts filled in."""
    from pyspark.sql import types as T

    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in EVENT_SCHEMA])

    def make(*rows, symbol="AAPL"):
        filled = []
        for row in rows:
            when, user, price, volume = (*row, *(None, "u", 1.0, 1)[len(row):])
            filled.append((at(when) if isinstance(when, str) else when, symbol, price, volume, user, "BUY"))
        return spark.createDataFrame(filled, nullable)

    return make
