"""Post-load validation, monitoring over time and independent reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions.measures import (
    count_where,
    mean,
    mean_of,
    pct,
    resolved_cases,
    rounded,
    total_cases,
)
from caseflow.functions.time import parse_timestamp
from caseflow.operators.contracts import rows_where
from caseflow.operators.joins import NULL_SPREAD, lookup_join
from caseflow.plans.analytics import created_period
from caseflow.schemas import RESOLVED_STATUS, UNRESOLVED_STATUSES


def fact_dq_counts(fact: DataFrame) -> DataFrame:
    flagged = count_where(F.col("has_any_dq_flag"))
    return fact.agg(
        count_where(F.col("dq_flag_closed_no_timestamp")).alias("closed_no_ts"),
        count_where(F.col("dq_flag_status_ts_mismatch")).alias("status_ts_mismatch"),
        count_where(F.col("dq_flag_orphan_customer")).alias("orphan_customer"),
        count_where(F.col("dq_flag_orphan_agent")).alias("orphan_agent"),
        flagged.alias("total_dq_flagged"),
        F.count("*").alias("total_rows"),
        pct(flagged, F.count("*"), 2).alias("dq_flag_pct"),
    )


def negative_resolution(fact: DataFrame) -> DataFrame:
    return rows_where(fact, F.col("resolution_hours") < 0, "negative_resolution_rows")


def closed_missing_resolution(fact: DataFrame) -> DataFrame:
    missing = (F.col("status") == RESOLVED_STATUS) & F.col("resolution_hours").isNull()
    return rows_where(fact, missing, "closed_missing_resolution")


def unmatched_keys(fact: DataFrame) -> DataFrame:
    return fact.agg(
        count_where(F.col("sk_customer").isNull()).alias("unmatched_customers"),
        count_where(F.col("sk_agent").isNull()).alias("unmatched_agents"),
    )


def duration_implies_closed(fact: DataFrame) -> DataFrame:
    broken = F.col("resolution_hours").isNotNull() & ~F.coalesce(F.col("is_resolved"), F.lit(False))
    return rows_where(fact, broken, "violations")


def sanity_by_priority(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("has_any_dq_flag") == F.lit(False))
        .groupBy("priority")
        .agg(
            F.count("*").alias("clean_cases"),
            resolved_cases(),
            mean_of(F.col("resolution_hours")).alias("avg_resolution_hours"),
            F.min("resolution_hours").cast("double").alias("min_hours"),
            F.max("resolution_hours").cast("double").alias("max_hours"),
        )
        .orderBy(F.desc_nulls_first("avg_resolution_hours"), "priority")
    )


def dq_drift_monthly(fact: DataFrame, spike_points: float = 5.0) -> DataFrame:
    """Flag rate per month of creation and its change; a rise above the limit is a spike.

    A month is compared with the calendar month before it, if that has cases; rows without a readable
    creation time have no month before them. The window runs over one row per month, bounded by the span of the calendar.
    """
    flagged = count_where(F.col("has_any_dq_flag"))
    monthly = fact.groupBy(created_period("month").alias("month")).agg(
        total_cases(),
        flagged.alias("dq_flagged"),
        pct(flagged, F.count("*")).alias("dq_flag_pct"),
    )
    in_order = W.partitionBy().orderBy(F.asc_nulls_last("month"))
    follows = F.lag("month").over(in_order) == F.add_months("month", -1)
    return (
        monthly.withColumn("previous_pct", F.when(follows, F.lag("dq_flag_pct").over(in_order)))
        .withColumn("change_points", F.round(F.col("dq_flag_pct") - F.col("previous_pct"), 1))
        .withColumn("spike", F.coalesce(F.col("change_points") > spike_points, F.lit(False)))
    )


def dq_drift_by_load(history: DataFrame, spike_points: float = 5.0) -> DataFrame:
    """Flag rate after each run and its change from the run before; a rise above the limit is a spike.

    The window runs over one row per run.
    """
    previous = F.lag("dq_flag_pct").over(W.partitionBy().orderBy("run_id"))
    changed = F.round(F.col("dq_flag_pct") - F.col("previous_pct"), 1)
    return (
        history.select("run_id", "fact_rows", "dq_flagged", "dq_flag_pct", previous.alias("previous_pct"))
        .withColumn("change_points", changed)
        .withColumn("spike", F.coalesce(F.col("change_points") > spike_points, F.lit(False)))
    )


# --- reconciliation ---------------------------------------------------------


def _profile(cases: DataFrame, hours: Column, clean: Column) -> DataFrame:
    """Counts and hours per priority, team and region: all headline numbers in one pass.

    The three are enumerations, so the result is small however many cases there are.
    """
    timed = clean & F.col("is_resolved") & hours.isNotNull()
    return cases.groupBy("priority", "team", "region").agg(
        F.count("*").alias("cases"),
        F.count_if(~clean).alias("flagged"),
        F.count_if(F.col("is_resolved")).alias("closed"),
        F.count_if(timed).alias("timed"),
        F.sum(F.when(timed, hours)).alias("hours"),
    )


def _unfold(profile: DataFrame, metrics: dict[str, tuple[str | None, str, str | None]]) -> DataFrame:
    """``metric, slice, total, n`` of each metric ``name: (slice column, total, count)``."""
    cells = [
        F.struct(
            F.lit(name).alias("metric"),
            (F.col(by) if by else F.lit("all")).alias("slice"),
            F.col(total).cast("decimal(38,6)").alias("total"),
            (F.col(n) if n else F.lit(None)).cast("long").alias("n"),
        )
        for name, (by, total, n) in metrics.items()
    ]
    return (
        profile.select(F.explode(F.array(*cells)).alias("c"))
        .groupBy("c.metric", "c.slice")
        .agg(F.sum("c.total").cast("decimal(26,6)").alias("total"), F.sum("c.n").alias("n"))
    )


# metric: slice column, total, and for averages the count
HEADLINES = {
    "cases": (None, "cases", None),
    "flagged": (None, "flagged", None),
    "clean_resolved": (None, "timed", None),
    "avg_hours": (None, "hours", "timed"),
    "avg_hours_by_priority": ("priority", "hours", "timed"),
    "avg_hours_by_team": ("team", "hours", "timed"),
    "cases_by_region": ("region", "cases", None),
    "closed_by_region": ("region", "closed", None),
    "closed_by_priority": ("priority", "closed", None),
}


def headline_metrics(cases: DataFrame, hours: Column, clean: Column) -> DataFrame:
    """The headline numbers as ``metric, slice, value`` (unrounded) from any case frame."""
    value = F.when(F.col("n").isNull(), F.col("total")).otherwise(
        F.try_divide(F.col("total"), F.col("n").cast("decimal(20,0)"))
    )
    return (
        _unfold(_profile(cases, hours, clean), HEADLINES)
        .filter(F.col("n").isNull() | (F.col("n") > 0))
        .select("metric", F.coalesce("slice", F.lit("(none)")).alias("slice"), value.alias("value"))
    )


def recomputed_cases(
    raw_cases: DataFrame, raw_customers: DataFrame, raw_agents: DataFrame
) -> DataFrame:
    """A second derivation, straight from RAW and without staging, dimensions or fact.

    Hours come from interval arithmetic, to a millionth of an hour.
    """
    customers = raw_customers.select(
        F.col("customer_id").alias("_cu"), F.upper(F.trim("region")).alias("region")
    )
    agents = raw_agents.select(F.col("agent_id").alias("_ag"), F.trim("team").alias("team"))
    cases = raw_cases.filter(F.col("case_id").isNotNull()).withColumns(
        {
            "_open": parse_timestamp(F.col("created_at")),
            "_close": parse_timestamp(F.col("closed_at")),
            "_status": F.trim("status"),
        }
    )
    closed = F.coalesce(F.col("_status") == RESOLVED_STATUS, F.lit(False))
    open_like = F.coalesce(F.col("_status").isin(*UNRESOLVED_STATUSES), F.lit(False))
    flagged = (
        (closed & F.col("closed_at").isNull())
        | (open_like & F.col("closed_at").isNotNull())
        | F.col("_open").isNull()
    )
    # whole seconds of both ends, as an exact decimal: no sum depends on the order of its rows
    opened, shut = (F.date_trunc("second", F.col(c)).cast("timestamp_ntz") for c in ("_open", "_close"))
    elapsed = shut - opened
    seconds = (
        F.extract(F.lit("DAY"), elapsed).cast("decimal(12,0)") * 86400
        + F.extract(F.lit("HOUR"), elapsed).cast("decimal(4,0)") * 3600
        + F.extract(F.lit("MINUTE"), elapsed).cast("decimal(4,0)") * 60
        + F.extract(F.lit("SECOND"), elapsed).cast("decimal(4,0)")
    )
    hours = (seconds / F.lit(3600)).cast("decimal(18,6)")
    # what the lookups may have to shuffle: results of the case, none of its texts but the keys
    narrow = cases.select(
        "customer_id",
        "agent_id",
        F.trim("priority").alias("priority"),
        closed.alias("is_resolved"),
        flagged.alias("_flagged"),
        F.when(closed & (F.col("_close") > F.col("_open")), hours).alias("hours"),
        F.pmod(F.xxhash64("case_id"), F.lit(NULL_SPREAD)).cast("int").alias("_spread"),
    )
    joined = lookup_join(narrow, customers, "customer_id", "_cu", "_spread")
    joined = lookup_join(joined, agents, "agent_id", "_ag", "_spread")
    return joined.select(
        "priority",
        "region",
        "team",
        "is_resolved",
        (F.col("_flagged") | F.col("_cu").isNull() | F.col("_ag").isNull()).alias("flagged"),
        "hours",
    )


def metric_reconciliation(
    fact: DataFrame,
    raw_cases: DataFrame,
    raw_customers: DataFrame,
    raw_agents: DataFrame,
    tolerance: float = 0.05,
) -> DataFrame:
    """Headline numbers of the fact against their recomputation from RAW.

    The difference is taken before rounding, since the fact stores hours with two decimals.
    """
    expected = headline_metrics(
        recomputed_cases(raw_cases, raw_customers, raw_agents), F.col("hours"), ~F.col("flagged")
    )
    actual = headline_metrics(fact, F.col("resolution_hours"), ~F.col("has_any_dq_flag"))
    difference = F.abs(F.col("expected") - F.col("actual"))
    return (
        expected.withColumnRenamed("value", "expected")
        .join(actual.withColumnRenamed("value", "actual"), ["metric", "slice"], "full")
        .select(
            "metric",
            "slice",
            rounded(F.col("expected")).alias("expected"),
            rounded(F.col("actual")).alias("actual"),
            rounded(difference, 2).alias("abs_diff"),
            F.coalesce(difference <= tolerance, F.lit(False)).alias("ok"),
        )
    )


# family: slice column, total, divisor, and the names of its two ends
EXTREMES = {
    "priority_hours": ("priority", "hours", "timed", "fastest_priority", "slowest_priority"),
    "team_hours": ("team", "hours", "timed", "fastest_team", "slowest_team"),
    "region_cases": ("region", "cases", None, "smallest_region", "largest_region"),
    "priority_closure": ("priority", "closed", "cases", "lowest_closure_priority", "highest_closure_priority"),
}


def metric_extremes(fact: DataFrame) -> DataFrame:
    """Slowest and fastest slices, and the ends of volume and closure; ties go by name."""
    clean = F.col("has_any_dq_flag") == F.lit(False)
    slices = _unfold(
        _profile(fact, F.col("resolution_hours"), clean),
        {name: (by, total, n) for name, (by, total, n, _, _) in EXTREMES.items()},
    ).filter(F.col("slice").isNotNull())
    value = (
        F.when(F.col("metric") == "priority_closure", pct(F.col("total"), F.col("n")))
        .when(F.col("n").isNull(), F.col("total").cast("double"))
        .otherwise(mean(F.col("total"), F.col("n")))
    )
    valued = slices.select("metric", "slice", value.alias("value")).filter(F.col("value").isNotNull())
    ends = valued.groupBy("metric").agg(
        F.min(F.struct("value", "slice")).alias("low"),
        F.min(F.struct((-F.col("value")).alias("value"), F.col("slice"))).alias("high"),
    )
    low_name, high_name = (
        F.create_map(*[F.lit(x) for name, e in EXTREMES.items() for x in (name, e[i])]) for i in (3, 4)
    )
    both = F.array(
        F.struct(
            low_name[F.col("metric")].alias("metric"), F.col("low.slice"), F.col("low.value").alias("value")
        ),
        F.struct(
            high_name[F.col("metric")].alias("metric"), F.col("high.slice"), (-F.col("high.value")).alias("value")
        ),
    )
    return ends.select(F.explode(both).alias("e")).select("e.metric", "e.slice", "e.value")
