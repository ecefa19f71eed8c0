"""The one-row-per-case fact, with region and team denormalised into it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions.time import date_key, ntz
from caseflow.operators.dims import current, lookup_as_of
from caseflow.operators.joins import lookup_join
from caseflow.operators.upsert import upsert_with_audit
from caseflow.schemas import DQ_FLAGS, RESOLVED_STATUS

FACT_COLUMNS = (
    "case_id", "sk_customer", "sk_agent", "created_date_key", "closed_date_key",
    "status", "priority", "category", "created_at", "closed_at",
    "resolution_hours", "resolution_bucket", "is_resolved",
    "customer_name", "region", "agent_name", "team",
    *DQ_FLAGS, "has_any_dq_flag",
)


def _business_columns(cases: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    return cases.withColumns(
        {
            "created_date_key": date_key(F.col("created_at")),
            "closed_date_key": date_key(F.col("closed_at")),
            "is_resolved": F.col("status") == RESOLVED_STATUS,
        }
    ).select(*FACT_COLUMNS, *flags)


def fact_source(
    stg_cases: DataFrame, dim_customer: DataFrame, dim_agent: DataFrame, flags: Sequence[str] = ()
) -> DataFrame:
    """Fact rows against the current dimension versions; cases without one keep NULLs. ``flags`` names
    the staged flags beyond the built-in ones."""
    customers = current(dim_customer).select(
        F.col("customer_id").alias("_customer"), "sk_customer", "customer_name", "region"
    )
    agents = current(dim_agent).select(
        F.col("agent_id").alias("_agent"), "sk_agent", "agent_name", "team"
    )
    joined = lookup_join(stg_cases, customers, "customer_id", "_customer", "case_id")
    joined = lookup_join(joined, agents, "agent_id", "_agent", "case_id")
    return _business_columns(joined, flags)


def fact_source_as_of(
    stg_cases: DataFrame, dim_customer: DataFrame, dim_agent: DataFrame
) -> DataFrame:
    """Fact rows against the dimension versions valid on the day the case was created."""
    created = F.col("created_at").cast("date")
    joined = lookup_as_of(
        stg_cases, dim_customer, "customer_id", created,
        ("sk_customer", "customer_name", "region"), "case_id",
    )
    joined = lookup_as_of(
        joined, dim_agent, "agent_id", created, ("sk_agent", "agent_name", "team"), "case_id"
    )
    return _business_columns(joined)


def load_fact(
    target: DataFrame | None, source: DataFrame, run_ts: datetime, flags: Sequence[str] = ()
) -> DataFrame:
    """Upsert by case; a first load needs no join, as there is nothing to merge with."""
    source = source.select(*FACT_COLUMNS, *flags)
    if target is None:
        now = ntz(run_ts)
        return source.select("*", now.alias("_loaded_at"), now.alias("_updated_at"))
    return upsert_with_audit(target, source, ["case_id"], run_ts)


def clustered_by_month(fact: DataFrame) -> DataFrame:
    """Fact rows laid out for ``partitionBy('created_month')``.

    Rebalancing lets AQE split a month that holds much of the data and merge small ones, so
    a month is written by as many tasks as its size asks for.
    """
    month = F.floor(F.col("created_date_key") / 100).cast("int")
    return (
        fact.withColumn("created_month", month)
        .hint("rebalance", "created_month")
        .sortWithinPartitions("created_month", "created_date_key")
    )


def created_between(fact: DataFrame, first_key: int, last_key: int) -> DataFrame:
    """Cases created in a ``yyyymmdd`` range; the month condition prunes whole folders."""
    return fact.filter(
        F.col("created_month").between(first_key // 100, last_key // 100)
        & F.col("created_date_key").between(first_key, last_key)
    )
