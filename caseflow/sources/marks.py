"""How far a feed has been loaded: its newest update time, stored with the run that loaded it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.sources.snapshots import SnapshotTable


class Marks:
    """One table for each feed, one row for each run; the mark is text, so no session zone moves it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _table(self, feed: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.path}/{feed}")

    def before(self, feed: str, run_id: int) -> str | None:
        """The mark as the last run before ``run_id`` left it; None loads everything."""
        stored = self._table(feed).read_before(run_id)
        return stored.first()["mark"] if stored is not None else None

    def advance(self, feed: str, loaded: DataFrame, updated_at: str, run_id: int) -> None:
        """Store the newest time of the rows a run has loaded; the mark never goes back. Only this column of the
        batch is read, nothing of the target."""
        known = F.lit(self.before(feed, run_id)).cast("string")
        newest = F.max(updated_at).cast("string")
        self._table(feed).write(loaded.agg(F.greatest(newest, known).alias("mark")), run_id)
