"""Governed reporting views: pure functions of the fact and the reference tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.measures import (
    avg_resolution,
    clean_resolved,
    closure_rate,
    count_where,
    mean_of,
    pct,
    resolved_cases,
    status_count,
    total_cases,
)
from caseflow.functions.time import ntz
from caseflow.plans.analytics import agent_stats
from caseflow.schemas import RESOLVED_STATUS, SLA_SCHEMA, SLA_TARGETS


def sla_policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SLA_TARGETS, SLA_SCHEMA)


def policy_coverage(fact: DataFrame, sla: DataFrame) -> DataFrame:
    """The policy against the priorities in use: those without a target show up as NULL."""
    used = fact.groupBy("priority").agg(total_cases())
    return used.join(sla, "priority", "full").select(
        "priority",
        "target_resolution_hrs",
        F.coalesce("total_cases", F.lit(0)).alias("total_cases"),
    )


def with_created_date(cases: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Calendar columns of the day a case was created.

    The calendar has one row per day of its span, whatever the number of cases, so it is
    broadcast; the same holds for the other role and for the policy.
    """
    created = dim_date.select(
        F.col("date_key").alias("_created_key"),
        F.col("full_date").alias("created_date"),
        F.col("year_num").alias("created_year"),
        F.col("quarter_label").alias("created_quarter"),
        F.col("month_name").alias("created_month"),
        F.col("is_weekend").alias("created_on_weekend"),
    )
    on = F.col("created_date_key") == F.col("_created_key")
    return cases.join(F.broadcast(created), on, "left").drop("_created_key")


def with_closed_date(cases: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Calendar columns of the day a case was closed, NULL while it is open."""
    closed = dim_date.select(
        F.col("date_key").alias("_closed_key"),
        F.col("full_date").alias("closed_date"),
        F.col("quarter_label").alias("closed_quarter"),
    )
    on = F.col("closed_date_key") == F.col("_closed_key")
    return cases.join(F.broadcast(closed), on, "left").drop("_closed_key")


def with_sla(cases: DataFrame, sla: DataFrame) -> DataFrame:
    """Target hours, and whether a clean and resolved case met them."""
    met = F.when(clean_resolved(), F.col("resolution_hours") <= F.col("target_resolution_hrs"))
    return cases.join(F.broadcast(sla), "priority", "left").withColumn("sla_met", met)


def case_base(fact: DataFrame) -> DataFrame:
    return fact.select(
        "case_id", "status", "priority", "category", "region", "team", "agent_name",
        "customer_name", "created_at", "closed_at", "resolution_hours", "resolution_bucket",
        "is_resolved", "has_any_dq_flag", "created_date_key", "closed_date_key",
    )


def case_enriched(fact: DataFrame, dim_date: DataFrame, sla: DataFrame) -> DataFrame:
    """One row per case with both calendar roles and the SLA verdict."""
    dated = with_closed_date(with_created_date(case_base(fact), dim_date), dim_date)
    return with_sla(dated, sla).drop("created_date_key", "closed_date_key")


def agent_scorecard(fact: DataFrame) -> DataFrame:
    return agent_stats(fact, {"dq_flagged_cases": F.col("has_any_dq_flag")})


def top10_agents_by_closure(fact: DataFrame) -> DataFrame:
    return (
        agent_scorecard(fact)
        .orderBy(
            F.desc("closure_rate_pct"), F.asc_nulls_last("agent_name"), F.asc_nulls_last("team")
        )
        .limit(10)
    )


def region_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("region").agg(
        total_cases(),
        resolved_cases(),
        closure_rate(),
        avg_resolution(),
        status_count("Open", "open_cases"),
        status_count("On Hold", "on_hold_cases"),
    )


def priority_sla(fact: DataFrame, sla: DataFrame) -> DataFrame:
    """SLA attainment; joins the policy only, as a left join on the calendar would stay.

    A priority without a target stays in the denominator, neither met nor breached.
    """
    met = count_where(F.col("sla_met"))
    return (
        with_sla(case_base(fact).filter(clean_resolved()), sla)
        .groupBy("priority", "target_resolution_hrs")
        .agg(
            F.count("*").alias("resolved_clean_cases"),
            mean_of(F.col("resolution_hours")).alias("avg_resolution_hours"),
            met.alias("met_sla"),
            count_where(F.col("sla_met") == F.lit(False)).alias("breached_sla"),
            pct(met, F.count("*")).alias("sla_attainment_pct"),
        )
    )


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Volume and resolution by calendar month of creation."""
    return (
        with_created_date(case_base(fact), dim_date)
        .groupBy("created_year", "created_month")
        .agg(total_cases(), resolved_cases(), avg_resolution())
    )


def dq_monitor(fact: DataFrame, checked_at: datetime, flags: Sequence[str] = ()) -> DataFrame:
    """One row of health checks from one pass; an empty fact still gives a row. ``flags`` are counted too."""
    flagged = count_where(F.col("has_any_dq_flag"))
    checks = fact.agg(
        F.count("*").alias("fact_rows"),
        flagged.alias("dq_flagged"),
        pct(flagged, F.count("*")).alias("dq_flag_pct"),
        count_where(F.col("resolution_hours") < 0).alias("negative_resolution_rows"),
        count_where(F.col("sk_customer").isNull()).alias("orphan_customers"),
        count_where(F.col("sk_agent").isNull()).alias("orphan_agents"),
        count_where(
            (F.col("status") == RESOLVED_STATUS) & F.col("resolution_hours").isNull()
        ).alias("closed_missing_resolution"),
        *[count_where(F.col(flag)).alias(flag) for flag in flags],
    )
    healthy = (
        (F.col("fact_rows") > 0)
        & (F.col("negative_resolution_rows") == 0)
        & (F.col("orphan_customers") == 0)
        & (F.col("orphan_agents") == 0)
    )
    return checks.select(
        ntz(checked_at).alias("checked_at"),
        "*",
        healthy.alias("pipeline_healthy"),
    )


def open_health_alert(monitor: DataFrame) -> DataFrame:
    return monitor.filter(F.col("pipeline_healthy") == F.lit(False))


def publish(views: dict[str, DataFrame]) -> None:
    """Register the views under their names for SQL and BI readers."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
