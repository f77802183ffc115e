"""Metric samples as CSV: one directory per metric and run, or one flat file per metric."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import METRIC_SCHEMA
from .files import TIMESTAMP_FORMAT
from .small_files import folders, read_text, replace_text

# The metrics kept and the one whose reading is text.
METRICS = ("latency", "throughput", "memory", "watermark_delays")
TEXT_METRIC = "watermark_delays"

_FLAT_SCHEMA = "timestamp timestamp, window_type string, reading string"
_RUN_SCHEMA = "timestamp timestamp, window_type string, value double, label string, metric string, run string"
# Tells the latest run of each metric; Spark's readers pass over names that begin so.
_LATEST = "_latest.json"


def write_metrics(samples: DataFrame, path: str, run: str, *, splits: int = 8) -> None:
    """Add one run's samples under ``path``, as CSV with a header per file.

    Runs are named so that the latest sorts last, for example by their start
    time ``20250101_120000``. Writing a run again replaces it. The samples of a
    metric are spread over up to ``splits`` tasks and files.

    When the samples are written, the file of the latest run of each metric is
    replaced; until then readers get the run before. One writer at a time.
    """
    spark = samples.sparkSession
    rows = samples.select("timestamp", "window_type", "value", "label", "metric", F.lit(run).alias("run"))
    salt = F.pmod(F.xxhash64("timestamp", "window_type", "value", "label"), F.lit(splits))
    (
        rows.repartition("metric", salt).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("metric", "run")
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    latest = _latest(spark, path)
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run)
    for folder in folders(spark, path, f"metric=*/run={name}"):
        metric, newer = folder.split("/")
        latest[metric] = max(newer, latest.get(metric, newer), key=_run_of)
    replace_text(spark, f"{path}/{_LATEST}", json.dumps(latest, sort_keys=True))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The latest run of every metric written by :func:`write_metrics`, runs compared as text.

    Names are those written, whatever letters they hold: they come from the
    partition columns. Only the folders of the latest runs are listed, however
    many runs there are.
    """
    latest = _latest(spark, path)
    if not latest:
        return spark.createDataFrame([], METRIC_SCHEMA)
    places = [f"{path}/{metric}/{run}" for metric, run in sorted(latest.items())]
    rows = spark.read.schema(_RUN_SCHEMA).option("header", True).option("basePath", path).csv(places)
    return rows.select(*METRIC_SCHEMA.names)


def _latest(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of the latest run by folder of the metric; where no file tells, from a listing of all."""
    known = read_text(spark, f"{path}/{_LATEST}")
    if known is not None:
        return json.loads(known)
    latest: dict[str, str] = {}
    for folder in folders(spark, path, "metric=*/run=*"):
        metric, run = folder.split("/")
        latest[metric] = max(run, latest.get(metric, run), key=_run_of)
    return latest


def _run_of(folder: str) -> str:
    """The run's name as it was given, without the escapes of folder names."""
    return re.sub("%([0-9A-F]{2})", lambda code: chr(int(code[1], 16)), folder.removeprefix("run="))


def read_flat_metrics(spark: SparkSession, path: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The most recently changed ``<metric>_<stamp>.csv`` of every metric in a directory."""
    name = F.element_at(F.split("path", "/"), -1)
    files = _listing(spark, path).withColumn("metric", _metric_of(name, metrics)).filter("metric is not null")
    newest = files.groupBy("metric").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
    # One row per metric name.
    paths = [row.path for row in newest.collect()]
    return _load(spark, paths, _metric_of(F.col("_metadata.file_name"), metrics))


def _metric_of(file_name, metrics):
    return F.coalesce(*[F.when(file_name.startswith(f"{metric}_"), metric) for metric in metrics])


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Paths and change times only: without its content column a file is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    return files.load(path).select("path", "modificationTime")


def _load(spark: SparkSession, paths: list[str], metric) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], METRIC_SCHEMA)
    rows = spark.read.schema(_FLAT_SCHEMA).option("header", True).csv(paths).withColumn("metric", metric)
    is_text = F.col("metric") == TEXT_METRIC
    return rows.select(
        "metric",
        "timestamp",
        "window_type",
        F.when(~is_text, F.col("reading").try_cast("double")).alias("value"),
        F.when(is_text, F.col("reading")).alias("label"),
    )
