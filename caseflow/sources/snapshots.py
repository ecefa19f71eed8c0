"""Parquet tables that are replaced as a whole, never overwritten in place.

Parquet has no MERGE, so an upsert writes a new snapshot next to the one it reads. A snapshot
counts once Spark's commit marker is there; a reader always sees the last complete one, and
a replayed batch finds its own snapshot and does nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caseflow.operators.incremental import upsert_latest
from caseflow.workspace import hadoop_path


class SnapshotTable:
    """``partition_by`` maps the columns to split by to their types, which folder names lose."""

    def __init__(
        self, spark: SparkSession, path: str, partition_by: dict[str, T.DataType] | None = None
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = partition_by or {}

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch-{batch_id:012d}"

    def _complete(self, folder: str) -> bool:
        fs, marker = hadoop_path(self.spark, f"{folder}/_SUCCESS")
        return fs.exists(marker)

    def batches(self) -> list[int]:
        """Ids of the complete snapshots, oldest first."""
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        ids = sorted(int(n[len("batch-") :]) for n in names if n.startswith("batch-"))
        return [i for i in ids if self._complete(self._folder(i))]

    def has(self, batch_id: int) -> bool:
        return self._complete(self._folder(batch_id))

    def folders(self, after: int = -1) -> list[str]:
        """Folders of the complete snapshots with a larger id than ``after``."""
        return [self._folder(i) for i in self.batches() if i > after]

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The last complete snapshot; an empty table of ``schema`` before the first one."""
        done = self.batches()
        if not done:
            if schema is None:
                raise FileNotFoundError(f"no complete snapshot under {self.path}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self._folder(done[-1]))

    def before(self, batch_id: int) -> list[int]:
        """Ids of the complete snapshots smaller than ``batch_id``, oldest first."""
        return [i for i in self.batches() if i < batch_id]

    def read_all_before(self, batch_id: int) -> DataFrame:
        """All complete snapshots with a smaller id together, for a table that only appends."""
        folders = [self._folder(i) for i in self.before(batch_id)]
        return self.spark.read.option("mergeSchema", True).parquet(*folders)

    def read_before(self, batch_id: int) -> DataFrame | None:
        """The last complete snapshot with a smaller id, None if there is none."""
        earlier = self.before(batch_id)
        if not earlier:
            return None
        folder = self._folder(earlier[-1])
        found = self.spark.read.parquet(folder).schema
        typed = [T.StructField(f.name, self.partition_by.get(f.name, f.dataType)) for f in found]
        return self.spark.read.schema(T.StructType(typed)).parquet(folder)

    def write(self, df: DataFrame, batch_id: int | None = None) -> DataFrame:
        """Write the next snapshot (or that of ``batch_id``) and return it as read back."""
        done = self.batches()
        target = batch_id if batch_id is not None else (done[-1] + 1 if done else 0)
        if not self.has(target):
            writer = df.write.mode("overwrite")
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            writer.parquet(self._folder(target))
        return self.spark.read.schema(df.schema).parquet(self._folder(target))


class ChangeTable:
    """A base snapshot and the change batches since: a batch costs what it holds, and the
    full table is rewritten only when it is compacted."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 updated_at: str):
        self.spark = spark
        self.schema = schema
        self.keys = list(keys)
        self.updated_at = updated_at
        self.base = SnapshotTable(spark, f"{path.rstrip('/')}/base")
        self.log = SnapshotTable(spark, f"{path.rstrip('/')}/changes")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch; one that is complete already is left as it is."""
        if not self.log.has(batch_id):
            self.log.write(batch, batch_id)

    def read(self) -> DataFrame:
        """The newest row per key of the base and the changes after it."""
        based_on = self.base.batches()
        base = self.base.read(self.schema)
        pending = self.log.folders(based_on[-1] if based_on else -1)
        if not pending:
            return base
        changes = self.spark.read.schema(self.schema).parquet(*pending)
        return upsert_latest(base, changes, self.keys, self.updated_at)

    def pending(self) -> int:
        """Number of change batches not yet in the base."""
        based_on = self.base.batches()
        return len(self.log.folders(based_on[-1] if based_on else -1))

    def compact(self) -> DataFrame:
        """Fold the changes into a new base, named after the last batch it holds."""
        batches = self.log.batches()
        if not self.pending():
            return self.read()
        return self.base.write(self.read(), batches[-1])
