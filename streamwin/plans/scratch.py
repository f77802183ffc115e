"""Where a query that has to write intermediate files puts them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name no one else uses, below the one the cluster shares.

    The shared folder is the session's ``spark.checkpoint.dir``. A local
    session without one, as in tests, gets a new temporary folder; on a cluster
    the executors could not see it, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="streamwin-")
    return f"{shared}/{purpose}-{uuid.uuid4().hex}"
