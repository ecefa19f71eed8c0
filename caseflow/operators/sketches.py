"""Mergeable sketches of the fact by month and slice, from which any range of months is answered.

A report over a range merges a few small rows and reads no case: distinct agents by HyperLogLog (relative
standard error 1.04 / sqrt(2 ** AGENT_BITS)), the median of hours by KLL (rank error below RANK_ERROR).
Counts are exact. Both are estimates for large groups; the exact operators stand beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions.measures import resolved_hours
from caseflow.sources.months import MONTH

AGENT_BITS = 12
AGENT_ERROR = 0.05  # three standard errors
HOURS_K = 400
RANK_ERROR = 0.02


def hundredths() -> Column:
    """Hours of resolved cases as whole hundredths; NULL else."""
    return (resolved_hours() * 100).cast("bigint")


def month_sketches(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each month and slice; a NULL month, agent or duration is kept out of nothing but its own sketch."""
    return fact.groupBy(MONTH, *keys).agg(
        F.count("*").alias("total_cases"),
        F.hll_sketch_agg("agent_name", AGENT_BITS).alias("agents"),
        F.kll_sketch_agg_bigint(hundredths(), HOURS_K).alias("hours"),
    )


def range_estimates(sketches: DataFrame, first_month: int, last_month: int, keys: Sequence[str]) -> DataFrame:
    """``total_cases`` and ``timed_cases`` (exact), ``agent_count`` and ``median_hours`` (estimates) by ``keys``,
    a part of the slice, over whole months ``yyyymm``. Without a timed case the median is NULL."""
    merged = (
        sketches.filter(F.col(MONTH).between(first_month, last_month))
        .groupBy(*keys)
        .agg(
            F.sum("total_cases").alias("total_cases"),
            F.hll_union_agg("agents").alias("agents"),
            F.kll_merge_agg_bigint("hours", HOURS_K).alias("hours"),
        )
        .withColumn("timed_cases", F.kll_sketch_get_n_bigint("hours"))
    )
    middle = F.kll_sketch_get_quantile_bigint("hours", F.lit(0.5))
    return merged.select(
        *keys,
        "total_cases",
        "timed_cases",
        F.hll_sketch_estimate("agents").alias("agent_count"),
        F.when(F.col("timed_cases") > 0, middle / F.lit(100)).alias("median_hours"),
    )
