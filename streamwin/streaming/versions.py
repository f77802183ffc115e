"""Results in update and complete mode as tables of files that readers always see whole.

Each micro-batch is written to a folder of its own, then a commit is added that
names it. A reader looks up the last commit first, so it sees the table before
the batch or after it, never in between. A batch that is handed over again
after a failure replaces its own folder and is committed again under its number.

    <root>/snapshots/version=<batch>   the whole table after a batch
    <root>/changes/version=<batch>     the rows a batch reported
    <root>/commits/batch=<batch>       one row: the batch, and the snapshot it builds on
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .runs import start_at_scale
from .writers import _triggered

TABLE_TRIGGER = "10 seconds"
# Changes are folded into a new snapshot once there are so many batches of them.
FOLD_EVERY = 20
_COMMIT = "batch long, snapshot long"


class VersionedTable:
    """A table below ``root``; ``keys`` tell its rows apart where batches report changed rows only.

    Rows with equal keys are merged: the ``newest`` one stays, or the other
    columns are added up (``sum``).
    """

    def __init__(self, root: str, schema: T.StructType, keys: Sequence[str] = (), merge: str = "newest"):
        if merge not in ("newest", "sum"):
            raise ValueError("rows are merged by 'newest' or 'sum'")
        self.root, self.schema, self.keys, self.merge = root, schema, list(keys), merge

    def last_commit(self, spark: SparkSession) -> tuple[int, int | None] | None:
        """The newest batch that can be read and the snapshot below it; ``None`` before the first."""
        folder = f"{self.root}/commits"
        if not _exists(spark, folder):
            return None
        found = spark.read.schema(_COMMIT).parquet(f"{folder}/batch=*")
        row = found.agg(F.max(F.struct("batch", "snapshot")).alias("last")).first()["last"]
        return (row["batch"], row["snapshot"]) if row else None

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of its last commit."""
        last = self.last_commit(spark)
        if last is None:
            return spark.createDataFrame([], self.schema)
        return self._as_of(spark, *last)

    def _as_of(self, spark: SparkSession, batch: int, snapshot: int | None) -> DataFrame:
        if snapshot == batch:
            return self._part(spark, "snapshots", [batch])
        rows = self._part(spark, "changes", list(range(0 if snapshot is None else snapshot + 1, batch + 1)), True)
        if snapshot is not None:
            rows = self._part(spark, "snapshots", [snapshot], True).unionByName(rows)
        values = [name for name in self.schema.names if name not in self.keys]
        if self.merge == "sum":
            added = [F.sum(name).cast(self.schema[name].dataType).alias(name) for name in values]
            return rows.groupBy(*self.keys).agg(*added).select(self.schema.names)
        newest = F.max_by(F.struct(*values), "_version").alias("_newest")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*").select(self.schema.names)

    def _part(self, spark: SparkSession, kind: str, versions: list[int], numbered: bool = False) -> DataFrame:
        paths = [path for version in versions if _exists(spark, path := f"{self.root}/{kind}/version={version}")]
        if not paths:
            rows = spark.createDataFrame([], self.schema)
            return rows.withColumn("_version", F.lit(None).cast("long")) if numbered else rows
        rows = spark.read.schema(self.schema).parquet(*paths)
        if not numbered:
            return rows
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/", 1).cast("long")
        return rows.select("*", version.alias("_version"))

    def put_snapshot(self, rows: DataFrame, batch: int, before_commit: Callable[[int], None] | None = None) -> None:
        """Replace the table by ``rows``."""
        rows.write.mode("overwrite").parquet(f"{self.root}/snapshots/version={batch}")
        self._commit(rows.sparkSession, batch, batch, before_commit)

    def put_changes(
        self,
        rows: DataFrame,
        batch: int,
        fold_every: int = FOLD_EVERY,
        before_commit: Callable[[int], None] | None = None,
    ) -> None:
        """Insert rows, or merge them with those with the same keys."""
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{self.root}/changes/version={batch}")
        last = self.last_commit(spark)
        snapshot = last[1] if last else None
        if snapshot == batch:  # This batch was committed before; what it built on is older.
            self._commit(spark, batch, batch, before_commit)
            return
        if batch - (-1 if snapshot is None else snapshot) >= fold_every:
            whole = self._as_of(spark, batch, snapshot)
            whole.write.mode("overwrite").parquet(f"{self.root}/snapshots/version={batch}")
            snapshot = batch
        self._commit(spark, batch, snapshot, before_commit)

    def _commit(self, spark, batch: int, snapshot: int | None, before_commit: Callable[[int], None] | None) -> None:
        if before_commit is not None:
            before_commit(batch)
        commit = spark.range(0, 1, 1, 1).select(
            F.lit(batch).cast("long").alias("batch"), F.lit(snapshot).cast("long").alias("snapshot")
        )
        commit.write.mode("overwrite").parquet(f"{self.root}/commits/batch={batch}")

    def forget(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete what the newest ``keep`` snapshots do not need; how many batches went. Slow readers need the older ones."""
        commits = f"{self.root}/commits"
        if not _exists(spark, commits):
            return 0
        found = spark.read.schema(_COMMIT).parquet(f"{commits}/batch=*").collect()
        kept = sorted({row["snapshot"] for row in found if row["snapshot"] is not None})[-keep:]
        old = [row["batch"] for row in found if len(kept) == keep and row["batch"] < kept[0]]
        for batch in sorted(old):
            for path in (f"{commits}/batch={batch}", *(f"{self.root}/{k}/version={batch}" for k in ("changes", "snapshots"))):
                _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(_path(spark, path), True)
        return len(old)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _exists(spark: SparkSession, path: str) -> bool:
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(_path(spark, path))


def start_upserts(
    result: DataFrame,
    table: VersionedTable,
    *,
    checkpoint_dir: str,
    trigger: str | dict | None = TABLE_TRIGGER,
    fold_every: int = FOLD_EVERY,
    state_partitions: int | None = None,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Keep ``table`` at the newest state of every window, those still open included: update mode.

    A micro-batch reports the windows it changed; they replace the rows with the
    table's keys. ``before_commit`` is called between the write of a batch and
    its commit.
    """
    if not table.keys:
        raise ValueError("rows of a table that is updated need keys")
    writer = result.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir)
    writer = writer.foreachBatch(lambda rows, batch: table.put_changes(rows, batch, fold_every, before_commit))
    return start_at_scale(result.sparkSession, _triggered(writer, trigger), state_partitions)


def start_snapshots(
    result: DataFrame,
    table: VersionedTable,
    *,
    checkpoint_dir: str,
    trigger: str | dict | None = TABLE_TRIGGER,
    state_partitions: int | None = None,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Replace ``table`` by the whole result after every micro-batch: complete mode, for results of bounded size."""
    writer = result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint_dir)
    writer = writer.foreachBatch(lambda rows, batch: table.put_snapshot(rows, batch, before_commit))
    return start_at_scale(result.sparkSession, _triggered(writer, trigger), state_partitions)
