"""Type-2 dimensions: surrogate keys, expiry, new versions, date-ranged lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions.time import ntz
from caseflow.operators.joins import lookup_join
from caseflow.schemas import OPEN_END

NUMBER_BUCKETS = 1024


def number_rows(rows: DataFrame, key: str, name: str, after: Column | int = 0) -> DataFrame:
    """Dense ids ``after + 1 ..`` over rows whose ``key`` is unique.

    Hash buckets are numbered side by side and shifted by the rows of the buckets before
    them. Bucket and order follow from the key alone, so a task that is run again gives
    every row the same id. The offsets are one row per bucket, a fixed bound.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(NUMBER_BUCKETS)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = W.partitionBy().orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(W.partitionBy("_bucket").orderBy(key))
    base = F.lit(after) if isinstance(after, int) else after
    return (
        bucketed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (base + F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_bucket", "_local", "_offset")
    )


def same_attributes(left: str, right: str, attributes: Sequence[str]) -> Column:
    """Null-safe equality of the tracked attributes of two aliased frames."""
    return reduce(
        Column.__and__, [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{a}")) for a in attributes]
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def changed_versions(
    dim: DataFrame, source: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Current versions whose key is in the source with other attributes."""
    differs = (F.col(f"d.{key}") == F.col(f"s.{key}")) & ~same_attributes("d", "s", attributes)
    return current(dim).alias("d").join(source.alias("s"), differs, "left_semi")


def new_versions(
    dim: DataFrame, source: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Source rows without an equal current version: new keys and changed ones."""
    equal = (F.col(f"s.{key}") == F.col(f"d.{key}")) & same_attributes("s", "d", attributes)
    return source.alias("s").join(current(dim).alias("d"), equal, "left_anti")


def expire(
    dim: DataFrame, source: DataFrame, key: str, attributes: Sequence[str], as_of: date
) -> DataFrame:
    """Close the current versions that changed; all other rows, vanished keys too, stay.

    The source key is unique, so the left join keeps one row per version. History takes no
    part in the join.
    """
    src = source.select(key, *attributes).alias("s")
    joined = current(dim).alias("d").join(src, F.col(f"d.{key}") == F.col(f"s.{key}"), "left")
    changed = F.col(f"s.{key}").isNotNull() & ~same_attributes("d", "s", attributes)
    replaced = {
        "valid_to": F.when(changed, F.date_sub(F.lit(as_of), 1)).otherwise(F.col("d.valid_to")),
        "is_current": ~changed,
    }
    live = joined.select(
        *[replaced[c].alias(c) if c in replaced else F.col(f"d.{c}") for c in dim.columns]
    )
    return dim.filter(~F.col("is_current")).unionByName(live)


def apply_changes(
    dim: DataFrame | None,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    surrogate: str,
    as_of: date,
    run_ts: datetime,
) -> DataFrame:
    """One type-2 run: expire what changed, add new and changed keys as open versions.

    ``dim`` is None on the first load. Known surrogate keys never change; new versions are
    numbered on from the largest one.
    """
    fresh = source if dim is None else new_versions(dim, source, key, attributes)
    numbered = number_rows(fresh.select(key, *attributes), key, surrogate)
    if dim is not None:
        highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
        numbered = numbered.withColumn(surrogate, F.col(surrogate) + highest)
    added = numbered.select(
        surrogate,
        key,
        *attributes,
        F.lit(as_of).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        ntz(run_ts).alias("_loaded_at"),
    )
    if dim is None:
        return added
    return expire(dim, source, key, attributes, as_of).select(*added.columns).unionByName(added)


def effective_ranges(dim: DataFrame, key: str) -> DataFrame:
    """Versions with the range they answer for.

    A version replaced on the day it began has an empty range and is left out. The earliest
    one that remains is open to the past, since the first load says nothing about before.
    """
    valid = dim.filter(F.col("valid_from") <= F.col("valid_to"))
    first = F.min("valid_from").over(W.partitionBy(key))
    past = F.make_date(F.lit(1), F.lit(1), F.lit(1))
    start = F.when(F.col("valid_from") == first, past).otherwise(F.col("valid_from"))
    return valid.withColumn("_from", start)


def lookup_as_of(
    rows: DataFrame, dim: DataFrame, key: str, on_date: Column, take: Sequence[str], spread_by: str
) -> DataFrame:
    """Left lookup of the version valid on ``on_date``: the key hashes, the range filters."""
    versions = effective_ranges(dim, key).select(
        F.col(key).alias("_key"), "_from", F.col("valid_to").alias("_to"), *take
    )
    valid = (F.col("_from") <= on_date) & (on_date <= F.col("_to"))
    return lookup_join(rows, versions, key, "_key", spread_by, valid).drop("_key", "_from", "_to")
