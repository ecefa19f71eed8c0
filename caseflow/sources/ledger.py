"""Which files a feed has loaded: each counts once, by path, length and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = ("path", "length", "modified")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length, modified`` of the files below ``folder``; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def new_files(spark: SparkSession, folder: str, loaded: DataFrame | None, run_id: int) -> DataFrame:
    """The files of ``folder`` that are not in the ledger ``loaded``, as rows to add to it."""
    files = list_files(spark, folder)
    if loaded is not None:
        files = files.join(loaded, list(FILE), "left_anti")
    return files.select(*FILE, F.lit(run_id).cast("long").alias("_run_id"))
