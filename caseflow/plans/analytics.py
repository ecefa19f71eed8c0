"""The business questions over the fact.

Resolution-time questions use clean and resolved cases; volume and closure use all cases;
where a report mixes both, counts are over all cases and durations over resolved ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions.measures import (
    avg_resolution,
    clean_resolved,
    closure_rate,
    count_where,
    mean,
    pct,
    ratio,
    resolved_cases,
    resolved_hours,
    rounded,
    status_count,
    total_cases,
)
from caseflow.functions.time import key_date
from caseflow.operators.fact import created_between
from caseflow.operators.median import aggregate_with_median

def _by_name(*columns: str) -> list[Column]:
    """Ascending order with NULL last, whatever Spark's default."""
    return [F.asc_nulls_last(c) for c in columns]


# --- resolution time: clean and resolved ------------------------------------


def overall_resolution(fact: DataFrame) -> DataFrame:
    total, n = F.sum("resolution_hours"), F.count("*")
    return fact.filter(clean_resolved()).agg(
        mean(total, n).alias("avg_resolution_hours"),
        ratio(total, n * 24, 2).alias("avg_resolution_days"),
        n.alias("resolved_cases"),
    )


def resolution_by(fact: DataFrame, key: str, with_range: bool = False) -> DataFrame:
    stats = aggregate_with_median(fact.filter(clean_resolved()), [key], F.col("resolution_hours"), {})
    columns = [
        F.col(key),
        F.col("n_values").alias("resolved_cases"),
        mean(F.col("sum_value"), F.col("n_values")).alias("avg_resolution_hours"),
        rounded(F.col("median")).alias("median_resolution_hours"),
    ]
    if with_range:
        columns += [
            rounded(F.col("min_value")).alias("min_hours"),
            rounded(F.col("max_value")).alias("max_hours"),
        ]
    return stats.select(*columns).orderBy(*_by_name("avg_resolution_hours", key))


def resolution_by_priority(fact: DataFrame) -> DataFrame:
    return resolution_by(fact, "priority", with_range=True)


def resolution_by_category(fact: DataFrame) -> DataFrame:
    return resolution_by(fact, "category")


def resolution_by_team(fact: DataFrame) -> DataFrame:
    return resolution_by(fact, "team")


def with_share(counted: DataFrame, count: str, share: str) -> DataFrame:
    """Add each row's share of the grand total of an aggregated frame.

    The total is a scalar subquery over the aggregate, so no window has to bring all rows
    into one task.
    """
    total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(share, pct(F.col(count), total))


def resolution_distribution(fact: DataFrame) -> DataFrame:
    counted = (
        fact.filter(clean_resolved())
        .groupBy("resolution_bucket")
        .agg(F.count("*").alias("resolved_cases"))
    )
    return with_share(counted, "resolved_cases", "pct_of_resolved").orderBy(
        F.desc("resolved_cases"), *_by_name("resolution_bucket")
    )


# --- volume and closure: all cases ------------------------------------------


def closure_by(fact: DataFrame, *keys: str) -> DataFrame:
    return (
        fact.groupBy(*keys)
        .agg(total_cases(), resolved_cases(), closure_rate())
        .orderBy(F.desc("total_cases"), *_by_name(*keys))
    )


def closure_by_category(fact: DataFrame) -> DataFrame:
    return closure_by(fact, "category")


def closure_by_priority(fact: DataFrame) -> DataFrame:
    return closure_by(fact, "priority")


def status_share(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("status").agg(total_cases())
    return with_share(counted, "total_cases", "pct_of_total").orderBy(
        F.desc("total_cases"), *_by_name("status")
    )


def segment_drilldown(
    fact: DataFrame, category: str = "Account", priority: str = "Urgent"
) -> DataFrame:
    """One segment of category x priority x status; the filter moves below the aggregate."""
    return closure_by(fact, "category", "priority", "status").filter(
        (F.col("category") == category) & (F.col("priority") == priority)
    )


def status_pivot(fact: DataFrame, key: str) -> DataFrame:
    """One column per known status; a plain conditional count needs a single pass."""
    return (
        fact.groupBy(key)
        .agg(
            status_count("Closed", "closed"),
            status_count("In Progress", "in_progress"),
            status_count("On Hold", "on_hold"),
            status_count("Open", "open_cases"),
            total_cases(),
        )
        .orderBy(F.desc("total_cases"), *_by_name(key))
    )


def pivot_category_status(fact: DataFrame) -> DataFrame:
    return status_pivot(fact, "category")


def pivot_priority_status(fact: DataFrame) -> DataFrame:
    return status_pivot(fact, "priority")


# --- agents and teams -------------------------------------------------------


def agent_stats(fact: DataFrame, counts: dict[str, Column]) -> DataFrame:
    stats = aggregate_with_median(
        fact,
        ["agent_name", "team"],
        resolved_hours(),
        {"total_cases": F.lit(True), "resolved_cases": F.col("is_resolved"), **counts},
    )
    return stats.select(
        "agent_name",
        "team",
        "total_cases",
        "resolved_cases",
        pct(F.col("resolved_cases"), F.col("total_cases")).alias("closure_rate_pct"),
        mean(F.col("sum_value"), F.col("n_values")).alias("avg_resolution_hours"),
        rounded(F.col("median")).alias("median_resolution_hours"),
        *counts,
    )


def agent_scorecard_full(fact: DataFrame) -> DataFrame:
    return agent_stats(
        fact,
        {
            "on_hold_cases": F.col("status") == "On Hold",
            "dq_flagged_cases": F.col("has_any_dq_flag"),
        },
    ).orderBy(F.desc("closure_rate_pct"), F.desc("total_cases"), *_by_name("agent_name", "team"))


def team_rollup(fact: DataFrame) -> DataFrame:
    """Agents are aggregated first, so the distinct count is a plain count of groups."""
    agents = fact.groupBy("team", "agent_name").agg(
        F.count("*").alias("n"),
        count_where(F.col("is_resolved")).alias("r"),
        F.sum(resolved_hours()).alias("hours"),
        F.count(resolved_hours()).alias("timed"),
    )
    total, agent_count = F.sum("n"), F.count("agent_name")
    return (
        agents.groupBy("team")
        .agg(
            total.alias("total_cases"),
            F.sum("r").alias("resolved_cases"),
            pct(F.sum("r"), total).alias("closure_rate_pct"),
            mean(F.sum("hours"), F.sum("timed")).alias("avg_resolution_hours"),
            agent_count.alias("agent_count"),
            ratio(total.cast("decimal(20,0)"), agent_count, 1).alias("cases_per_agent"),
        )
        .orderBy(*_by_name("avg_resolution_hours", "team"))
    )


def top3_agents_per_team(fact: DataFrame) -> DataFrame:
    """Ties share a rank, and agents without a duration rank last; all ties are kept."""
    agents = fact.groupBy("agent_name", "team").agg(
        total_cases(), resolved_cases(), avg_resolution(), closure_rate()
    )
    fastest = W.partitionBy("team").orderBy(F.asc_nulls_last("avg_resolution_hours"))
    return (
        agents.withColumn("rank_in_team", F.rank().over(fastest))
        .filter(F.col("rank_in_team") <= 3)
        .orderBy(*_by_name("team", "rank_in_team", "agent_name"))
    )


# --- customers and regions --------------------------------------------------


def region_volume(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("region")
        .agg(
            total_cases(),
            resolved_cases(),
            closure_rate(),
            avg_resolution(),
            status_count("On Hold", "on_hold_cases"),
            status_count("Open", "open_cases"),
        )
        .orderBy(F.desc("total_cases"), *_by_name("region"))
    )


def region_by_category(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("region", "category")
        .agg(total_cases(), avg_resolution())
        .orderBy(*_by_name("region"), F.desc("total_cases"), *_by_name("category"))
    )


def top10_customers(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("customer_name", "region")
        .agg(
            total_cases(),
            resolved_cases(),
            avg_resolution(),
            count_where(F.col("priority") == "Urgent").alias("urgent_cases"),
        )
        .orderBy(F.desc("total_cases"), *_by_name("customer_name", "region"))
        .limit(10)
    )


def created_period(unit: str) -> Column:
    """First day of the month or quarter of creation.

    Taken from the date key: the fact is sorted by it, so it is stored in next to no space,
    unlike the timestamp.
    """
    return F.trunc(key_date(F.col("created_date_key")), unit)


def monthly_volume(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(created_period("month").alias("month"))
        .agg(total_cases(), resolved_cases(), avg_resolution())
        .orderBy(*_by_name("month"))
    )


def region_quarter(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("region", created_period("quarter").alias("quarter"))
        .agg(total_cases(), avg_resolution())
        .orderBy(*_by_name("quarter", "region"))
    )


def preview(table: DataFrame, key: str, n: int = 20) -> DataFrame:
    return table.orderBy(key).limit(n)


def created_range_trend(fact: DataFrame, first_key: int, last_key: int) -> DataFrame:
    """Monthly trend of a date range; only the folders of its months are read."""
    return (
        created_between(fact, first_key, last_key)
        .groupBy("created_month")
        .agg(total_cases(), resolved_cases(), avg_resolution())
    )
