"""Small text files on the file system of a path, replaced as a whole, and folders by pattern."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The contents of a file; ``None`` if there is none."""
    place, system = _located(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file beside the old one, then rename it over it: readers see the old text or the new one."""
    fresh, system = _located(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(fresh), system.makeQualified(_located(spark, path)[0]), overwrite)


def folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root`` that match, from ``root`` on. Only levels with a wildcard are listed."""
    place, system = _located(spark, f"{root}/{pattern}")
    depth = pattern.count("/") + 1
    found = system.globStatus(place) or []
    return sorted("/".join(status.getPath().toString().split("/")[-depth:]) for status in found)
