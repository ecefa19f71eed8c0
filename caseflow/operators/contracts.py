"""Data contracts. Each check is a tidy frame ``check, object, violations, ok``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.operators.joins import unmatched_counts


def _result(df: DataFrame, check: str, name: str, violations: Column) -> DataFrame:
    counted = df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))
    return counted.select(
        F.lit(check).alias("check"),
        F.lit(name).alias("object"),
        "violations",
        (F.col("violations") == 0).alias("ok"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return _result(repeated, "unique", f"{name}.{'+'.join(keys)}", F.count("*"))


def _per_column(df: DataFrame, check: str, name: str, violations: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, for each column, from one pass."""
    counted = df.agg(*[F.count_if(v).alias(c) for c, v in violations.items()])
    entries = [
        F.struct(F.lit(f"{name}.{c}").alias("object"), F.col(c).alias("violations")) for c in violations
    ]
    return counted.select(F.explode(F.array(*entries)).alias("r")).select(
        F.lit(check).alias("check"),
        "r.object",
        "r.violations",
        (F.col("r.violations") == 0).alias("ok"),
    )


def not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """NULL or blank values per column."""
    blank = {c: F.coalesce(F.trim(c) == "", F.lit(True)) for c in columns}
    return _per_column(df, "not_null", name, blank)


def max_length(df: DataFrame, widths: dict[str, int], name: str) -> DataFrame:
    """Values longer than their column may be; Spark strings have no width of their own."""
    return _per_column(df, "max_length", name, {c: F.char_length(c) > n for c, n in widths.items()})


def unexpected_values(df: DataFrame, accepted: dict[str, Sequence[str]], name: str) -> DataFrame:
    """Rows per value outside the accepted set, for all enumerated columns in one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in accepted])
    )
    counted = df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(
        F.count("*").alias("row_count")
    )
    fine = reduce(
        Column.__or__,
        [(F.col("column") == c) & F.col("value").isin(*values) for c, values in accepted.items()],
    )
    return counted.filter(~F.coalesce(fine, F.lit(False))).select(
        F.concat(F.lit(f"{name}."), F.col("column")).alias("object"), "value", "row_count"
    )


def relationship(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, child_name: str, parent_name: str
) -> DataFrame:
    """Child rows whose key no parent has; a NULL key counts."""
    return _result(
        unmatched_counts(child, fk, parent, pk),
        "relationships",
        f"{child_name}.{fk} -> {parent_name}.{pk}",
        F.sum("row_count"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
            for name, df in tables.items()
        ]
    )


def expected_row_counts(actual: dict[str, DataFrame], expected: dict[str, DataFrame]) -> DataFrame:
    counts = row_counts(actual).withColumnRenamed("row_count", "actual")
    wanted = row_counts(expected).withColumnRenamed("row_count", "expected")
    return counts.join(wanted, "tbl").withColumn("ok", F.col("actual") == F.col("expected"))


def dq_summary(staged: DataFrame) -> DataFrame:
    flags = {
        "closed_no_ts": "dq_flag_closed_no_timestamp",
        "status_mismatch": "dq_flag_status_ts_mismatch",
        "bad_created_at": "dq_flag_invalid_created_at",
        "orphan_customer": "dq_flag_orphan_customer",
        "orphan_agent": "dq_flag_orphan_agent",
        "total_flagged": "has_any_dq_flag",
    }
    return staged.agg(
        *[F.count_if(F.col(c)).alias(n) for n, c in flags.items()],
        F.count("*").alias("total_rows"),
    )


def rows_where(df: DataFrame, violation: Column, name: str) -> DataFrame:
    return df.filter(violation).agg(F.count("*").alias(name))


def rows_preserved(layers: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows and keyed rows of consecutive layers, and whether the next layer kept them all."""
    counts = [
        df.agg(F.count("*").alias("n"), F.count(key).alias("keyed")).select(
            F.lit(i).alias("position"), F.lit(name).alias("layer"), "n", "keyed"
        )
        for i, (name, df) in enumerate(layers.items())
    ]
    all_counts = union_all(counts)
    # one row for each layer
    before = F.lag("keyed").over(W.partitionBy().orderBy("position"))
    return all_counts.withColumn("expected_rows", before).select(
        "layer",
        F.col("n").alias("row_count"),
        F.coalesce(F.col("expected_rows"), F.col("n")).alias("expected_rows"),
        (F.coalesce(F.col("expected_rows"), F.col("n")) == F.col("n")).alias("ok"),
    )
