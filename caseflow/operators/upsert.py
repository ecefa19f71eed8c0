"""Upsert by key. Parquet has no MERGE, so the merged table is a new DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions.time import ntz

AUDIT = ("_loaded_at", "_updated_at")


def one_per_key(source: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """At most one row per key: the latest by ``order_by``, else a second row is an error.

    The latest row is picked on the map side first, so a key that fills a third of the batch
    reaches its reducer as one row per map task. The check numbers the rows of a key as they
    stream by; the merge that follows reuses its partitioning and order.
    """
    if order_by is None:
        nth = F.row_number().over(W.partitionBy(*keys).orderBy(*keys))
        key_text = F.to_json(F.struct(*keys))
        duplicate = F.raise_error(F.concat(F.lit("duplicate merge key: "), key_text)).cast("boolean")
        checked = F.when(F.col("_nth") > 1, duplicate).otherwise(F.lit(True))
        return source.withColumn("_nth", nth).filter(checked).drop("_nth")
    rest = [c for c in source.columns if c not in keys]
    # The whole row breaks ties, so a repeated run keeps the same one.
    latest = F.max(F.struct(F.col(order_by), F.struct(*rest).alias("row"))).alias("_latest")
    picked = source.groupBy(*keys).agg(latest)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_latest.row.{c}") for c in source.columns])


def last_delivered(rows: DataFrame, key: str, run: str) -> DataFrame:
    """``rows`` without those whose key a later ``run`` holds again; rows without a key stay.

    Only keys that several runs hold take part in the anti join, and they are counted first.
    """
    runs = rows.groupBy(F.col(key).alias("_key")).agg(F.max(run).alias("_last"), F.min(run).alias("_first"))
    again = runs.filter(F.col("_first") < F.col("_last")).select("_key", "_last")
    return rows.join(again, (F.col(key) == F.col("_key")) & (F.col(run) < F.col("_last")), "left_anti")


def require_unique(rows: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    """``rows``, once a job has found no key twice; it reads and shuffles the key columns alone.

    For a table that is written as it comes, with no merge that would check its rows on the way.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    repeated = counts.filter(F.col("_n") > 1).drop("_n").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate key in {what}: {repeated[0].asDict()}")
    return rows


def with_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """``target`` with the columns only ``source`` has, as NULLs: additive schema changes."""
    known = set(target.columns)
    added = [f for f in source.schema.fields if f.name not in known]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])


def same_columns(
    target: DataFrame, source: DataFrame, keys: Sequence[str], apart: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the union of their columns, so that no merge loses one.

    A column new in the source is NULL in target rows. A column the source lacks is taken from the
    target row of the same key, NULL for a new key; ``apart`` names target columns that the merge
    itself fills. Where the source has all columns, nothing is joined.
    """
    target = with_new_columns(target, source)
    lacking = [c for c in target.columns if c not in source.columns and c not in apart]
    if not lacking:
        return target, source
    kept = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *lacking)
    on = [F.col(f"_t_{k}") == F.col(k) for k in keys]
    whole = source.join(kept, on, "left").drop(*[f"_t_{k}" for k in keys])
    return target, whole.select(*source.columns, *lacking)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """Source rows replace target rows of the same key; other target rows stay.

    A column that is new in the source is NULL in the rows that stay. The anti join needs only
    the source keys, repeated or not. A batch below Spark's broadcast threshold therefore
    merges without shuffling the target.
    """
    target, source = same_columns(target, source, keys)
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.select(*source.columns).unionByName(one_per_key(source, keys, order_by))


def upsert_with_audit(
    target: DataFrame, source: DataFrame, keys: Sequence[str], run_ts: datetime
) -> DataFrame:
    """Full refresh of every business column; ``_loaded_at`` of a known key is kept.

    ``target`` has the columns of ``source`` plus the two audit columns. The keys are unique
    on both sides, so one full outer join on them cannot skew.
    """
    target, source = same_columns(target, source, keys, AUDIT)
    business = [c for c in source.columns if c not in keys]
    now = ntz(run_ts)
    src = one_per_key(source, keys).select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*business).alias("_src")
    )
    tgt = target.select(
        *[F.col(k).alias(f"_t_{k}") for k in keys], F.struct(*business).alias("_tgt"), *AUDIT
    )
    on = [F.col(f"_s_{k}") == F.col(f"_t_{k}") for k in keys]
    incoming = F.col("_src").isNotNull()
    merged = src.join(tgt, on, "full")

    def take(name: str) -> Column:
        return (
            F.when(incoming, F.col("_src").getField(name))
            .otherwise(F.col("_tgt").getField(name))
            .alias(name)
        )

    return merged.select(
        *[
            F.coalesce(F.col(f"_s_{c}"), F.col(f"_t_{c}")).alias(c) if c in keys else take(c)
            for c in source.columns
        ],
        F.coalesce(F.col("_loaded_at"), now).alias("_loaded_at"),
        F.when(incoming, now).otherwise(F.col("_updated_at")).alias("_updated_at"),
    )


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row counts of both tables and the keys that are new, gone or different."""
    columns = [c for c in before.columns if c not in keys]
    a = before.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*columns).alias("_a"))
    b = after.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*columns).alias("_b"))
    on = [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in keys]
    return a.join(b, on, "full").agg(
        F.count("_a").alias("rows_before"),
        F.count("_b").alias("rows_after"),
        F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("changed_rows"),
    )
