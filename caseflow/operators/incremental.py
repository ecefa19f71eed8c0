"""Incremental upsert on an updated-at high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators.upsert import one_per_key, same_columns


def since_watermark(
    source: DataFrame, target: DataFrame, updated_at: str, overlap: timedelta | None = None
) -> DataFrame:
    """Source rows at or after the newest row of ``target``, less ``overlap``; the mark costs a scan of its times.

    See :func:`since_mark`, which takes a mark that the run before has stored.
    """
    mark = target.agg(F.max(updated_at).cast("string")).first()[0]
    return since_mark(source, mark, updated_at, overlap)


def since_mark(
    source: DataFrame, mark: str | None, updated_at: str, overlap: timedelta | None = None
) -> DataFrame:
    """Source rows at or after ``mark``, less ``overlap``; all of them without a mark.

    Rows later than their time by up to ``overlap`` are still taken, and rows without a time are
    taken always; the upsert, in which a row without a time gives way to any other of its key,
    makes both harmless.

    The mark is one value, pushed into the scan as a literal; as text it keeps
    its meaning in any session zone. Rows equal to it are taken again, because the last run
    may have seen only some of them; the upsert makes that harmless.
    """
    if mark is None:
        return source
    start = F.lit(mark).cast(source.schema[updated_at].dataType)
    if overlap is not None:
        start = start - F.lit(overlap)
    return source.filter((F.col(updated_at) >= start) | F.col(updated_at).isNull())


def upsert_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], updated_at: str
) -> DataFrame:
    """Keep the newest row per key of target and batch, also if the batch is out of order.

    The target is read once in full, each row next to the newest of its key in the batch, and once more
    for its keys alone, which say what is new. With a batch below Spark's broadcast threshold neither read
    shuffles the target. The target has each key once; of equal times the greater row stays.
    """
    keys = list(keys)
    target, batch = same_columns(target, batch, keys)
    newest = one_per_key(batch, keys, order_by=updated_at)
    rest = [c for c in batch.columns if c not in keys]
    row = F.struct(F.col(updated_at), F.struct(*rest).alias("row"))
    incoming = newest.select(*keys, row.alias("_new"))
    kept = target.join(incoming, keys, "left").select(*keys, F.greatest(row, F.col("_new")).alias("_kept"))
    columns = [F.col(c) if c in keys else F.col(f"_kept.row.{c}").alias(c) for c in batch.columns]
    inserted = newest.join(target.select(*keys), keys, "left_anti")
    return kept.select(*columns).unionByName(inserted)
