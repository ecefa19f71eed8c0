"""KPI measures. Rates and averages are divided as exact decimals, then rounded half away
from zero, so a result does not depend on the order in which rows are summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflow.schemas import DQ_FLAGS

_COUNT = "decimal(20,0)"


def clean_resolved() -> Column:
    """Population of the resolution-time KPIs; a NULL flag is not clean."""
    return (
        (F.col("has_any_dq_flag") == F.lit(False))
        & F.col("is_resolved")
        & F.col("resolution_hours").isNotNull()
    )


def any_flag() -> Column:
    flag = F.col(DQ_FLAGS[0])
    for name in DQ_FLAGS[1:]:
        flag = flag | F.col(name)
    return flag


def count_where(predicate: Column) -> Column:
    """Rows where the predicate is TRUE (NULL does not count)."""
    return F.count_if(predicate)


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` of exact types, rounded; NULL over zero."""
    quotient = F.try_divide(numerator, denominator.cast(_COUNT))
    return F.round(quotient, scale).cast("double")


def pct(part: Column, whole: Column, scale: int = 1) -> Column:
    return ratio(part.cast(_COUNT) * 100, whole, scale)


def mean(total: Column, n: Column, scale: int = 1) -> Column:
    return ratio(total, n, scale)


def mean_of(value: Column, scale: int = 1) -> Column:
    """Rounded mean of a decimal column inside an aggregation; NULLs are left out."""
    return mean(F.sum(value), F.count(value), scale)


def resolved_hours() -> Column:
    """Hours of resolved cases, NULL for the others."""
    return F.when(F.col("is_resolved"), F.col("resolution_hours"))


def rounded(value: Column, scale: int = 1) -> Column:
    return F.round(value, scale).cast("double")


def total_cases() -> Column:
    return F.count("*").alias("total_cases")


def resolved_cases() -> Column:
    return count_where(F.col("is_resolved")).alias("resolved_cases")


def closure_rate() -> Column:
    return pct(count_where(F.col("is_resolved")), F.count("*")).alias("closure_rate_pct")


def avg_resolution() -> Column:
    return mean_of(resolved_hours()).alias("avg_resolution_hours")


def status_count(status: str, name: str) -> Column:
    return count_where(F.col("status") == status).alias(name)
