"""Load each landing file once: the file source remembers what it has read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions.text import clean_strings
from caseflow.sources.landing import CSV_OPTIONS, with_audit


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    run_ts: datetime,
    max_files: int = 10_000,
) -> DataFrame:
    """Append the files that arrived since the last run and return all rows loaded so far.

    The run drains what is there and stops. Checkpoint and file sink together make a repeated
    or broken-off run load nothing twice.
    """
    rows = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", max_files)
        .csv(landing)
        .select(*schema.names, F.col("_metadata.file_path").alias("_source_file"))
    )
    landed = with_audit(clean_strings(rows), run_ts, F.col("_source_file"))
    query = (
        landed.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(sink)
