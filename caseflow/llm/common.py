"""Helpers shared by the operators: derived tables on shared storage, text batches."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import threading
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.workspace import hadoop_path, scratch

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Whether the shuffle files of a query go as soon as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    It cuts the lineage: what is built on the result never runs ``df`` again, and a lost
    executor costs a re-read. With ``tidy``, what ``df`` has shuffled goes once it is written,
    not only when the driver's garbage is collected.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, str(tidy or before == "true").lower())
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark resolves it to, so that Arrow finds the same file system in every worker."""
    fs, path = hadoop_path(spark, folder)
    return fs.makeQualified(path).toString()


# Schemes of Hadoop's connectors that Arrow knows by another name.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """A qualified folder under the scheme that Arrow knows."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{uri} has no scheme")
    if scheme == "file":
        return f"file:///{rest.lstrip('/')}"
    return f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}"


def store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system of a qualified folder, and the path there."""
    return arrow_fs.FileSystem.from_uri(arrow_uri(uri))


def discard(spark: SparkSession, path: str) -> None:
    """Remove a derived table that nothing reads any more."""
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text of a batch; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def ranges(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of values of these sizes, each of about ``limit`` in all, so that no working set follows the batch."""
    begin = end = total = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield begin, end
            begin, total = end, 0
    if begin < end:
        yield begin, end


def chunks(values: Sequence[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``values`` of about ``limit`` bytes."""
    return ranges(map(len, values), limit)


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send the library to the Python workers, once for each application.

    Functions then refer to its modules by name, so what a worker caches there outlives a task.
    """
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        uri = f"{scratch(spark, 'code')}/caseflow-workers.zip"
        fs, where = hadoop_path(spark, uri)
        out = fs.create(where)
        out.write(held.getvalue())
        out.close()
        context.addPyFile(uri)
        _shipped.add(context.applicationId)


# Text that a Python worker gets at once; with it a worker's working set stays small whatever the rows.
BATCH_BYTES = "8m"


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with the library at hand in the workers, over batches of bounded size."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


_held: dict[object, object] = {}
_family: list[str] = []


def return_free_memory() -> None:
    """What is free goes back to the system: Arrow's memory and, where the C library can do that, small objects."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_cache(family: str, key: object, make: Callable[[], object]):
    """What ``make`` gives, kept in the process between tasks until another family of operators runs in
    it: a worker that serves several operators holds the caches of one."""
    if _family != [family]:
        _held.clear()
        _family[:] = [family]
        gc.collect()
        return_free_memory()
    if key not in _held:
        _held[key] = make()
    return _held[key]


def without_caches(family: str) -> None:
    """What other operators keep in the process goes; for a family that keeps nothing itself."""
    worker_cache(family, "none", dict)
