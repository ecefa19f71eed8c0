"""A table split by month, of which a run writes the months it touches and takes over the others.

A run's folder holds only its months, next to a list of them: a touched month that has no folder there has no
rows left. A reader takes every month from the last complete run that touched it, in one scan whose folders
Spark prunes by month. There is no other bookkeeping.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions.time import date_key
from caseflow.workspace import hadoop_path

MONTH = "created_month"
_RUN = "batch"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"

Months = Collection[int | None]


def month_of(created: Column) -> Column:
    """Integer ``yyyymm``; NULL passes through."""
    return F.floor(date_key(created) / 100).cast("int")


def in_months(months: Months) -> Column:
    """A condition on the month column that prunes folders."""
    known = F.col(MONTH).isin([m for m in months if m is not None])
    return known | F.col(MONTH).isNull() if None in months else F.coalesce(known, F.lit(False))


def months_of(rows: DataFrame) -> set[int | None]:
    """The months of ``rows``: at most one value for each month of the calendar reaches the driver."""
    return {r[0] for r in rows.select(MONTH).distinct().collect()}


class MonthTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, run: int) -> str:
        return f"{self.path}/{_RUN}={run}"

    def has(self, run: int) -> bool:
        fs, marker = hadoop_path(self.spark, f"{self._folder(run)}/_SUCCESS")
        return fs.exists(marker)

    def _names(self, path: str) -> list[str]:
        fs, folder = hadoop_path(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def runs(self) -> list[int]:
        """Complete runs, oldest first."""
        found = (n[len(_RUN) + 1 :] for n in self._names(self.path) if n.startswith(f"{_RUN}="))
        return [run for run in sorted(map(int, found)) if self.has(run)]

    def folders(self, through: int) -> list[str]:
        """The folder of every month as of run ``through``, each from the last run that touched it."""
        chosen: dict[str, str | None] = {}
        for run in reversed([r for r in self.runs() if r <= through]):
            names = [n for n in self._names(self._folder(run)) if n.startswith(f"{MONTH}=")]
            touched = self._touched(run)
            for name in names if touched is None else touched:
                chosen.setdefault(name, f"{self._folder(run)}/{name}" if name in names else None)
            if touched is None:
                break
        return sorted(folder for folder in chosen.values() if folder)

    def _touched(self, run: int) -> list[str] | None:
        """Folder names of the months a run touched, None for all."""
        fs, path = hadoop_path(self.spark, f"{self.path}/_touched-{run}")
        if not fs.exists(path):
            return None
        rows = self.spark.read.text(f"{self.path}/_touched-{run}").collect()
        return [r["value"] for r in rows]

    def touched(self, run: int) -> set[int | None] | None:
        """The months a run has replaced, None for all."""
        names = self._touched(run)
        if names is None:
            return None
        values = (name[len(MONTH) + 1 :] for name in names)
        return {None if value == _NO_MONTH else int(value) for value in values}

    def read(self, through: int, schema: T.StructType) -> DataFrame:
        folders = self.folders(through)
        if not folders:
            return self.spark.createDataFrame([], schema)
        fields = [f for f in schema.fields if f.name != MONTH]
        whole = T.StructType([*fields, T.StructField(_RUN, T.LongType()), T.StructField(MONTH, T.IntegerType())])
        found = self.spark.read.schema(whole).option("basePath", self.path).parquet(*folders)
        return found.select(*schema.names)

    def before(self, run: int) -> DataFrame | None:
        """The table as the last complete run before ``run`` left it, None if there is none."""
        earlier = [r for r in self.runs() if r < run]
        if not earlier:
            return None
        folders = self.folders(earlier[-1])
        found = self.spark.read.option("basePath", self.path).option("mergeSchema", True).parquet(*folders)
        typed = [T.StructField(f.name, T.IntegerType() if f.name == MONTH else f.dataType) for f in found.schema if f.name != _RUN]
        return self.read(earlier[-1], T.StructType(typed))

    def write(self, rows: DataFrame, run: int, touched: Months | None = None) -> DataFrame:
        """Write the months of ``rows``; with ``touched``, those and no others are replaced. A run that is
        there already is left as it is. Returns the whole table."""
        if not self.has(run):
            if touched is not None:
                names = [(f"{MONTH}={_NO_MONTH if m is None else m}",) for m in sorted(touched, key=str)]
                listed = self.spark.createDataFrame(names, "value string").coalesce(1)
                listed.write.mode("overwrite").text(f"{self.path}/_touched-{run}")
            rows.write.mode("overwrite").partitionBy(MONTH).parquet(self._folder(run))
        return self.read(run, rows.schema)
