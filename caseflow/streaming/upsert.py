"""Streaming upsert: change files into a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caseflow.sources.snapshots import ChangeTable


def merge_batch(table: ChangeTable, batch: DataFrame, batch_id: int, compact_every: int) -> None:
    """Log one micro-batch under its id, so a replay changes nothing; compact now and then."""
    table.append(batch, batch_id)
    if table.pending() >= compact_every:
        table.compact()


def upsert_new_files(
    table: ChangeTable, changes: str, checkpoint: str, compact_every: int = 50
) -> DataFrame:
    """Merge the change files that arrived since the last run and return the table."""
    query = (
        table.spark.readStream.schema(table.schema)
        .parquet(changes)
        .writeStream.foreachBatch(
            lambda batch, batch_id: merge_batch(table, batch, batch_id, compact_every)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read()
