"""Typed staging: parse, normalise, derive durations and data-quality flags.

Rows are flagged, never dropped; only a row without its business key is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions.measures import any_flag
from caseflow.functions.time import (
    duration_bucket,
    hours_between,
    ntz,
    parse_date,
    parse_timestamp,
    rounded_hours,
)
from caseflow.operators.joins import lookup_join, unmatched_counts
from caseflow.schemas import DQ_FLAGS, RESOLVED_STATUS, UNRESOLVED_STATUSES


class Rule(NamedTuple):
    """A data-quality flag as data: ``when`` is a predicate on the columns of :func:`parse_cases`, NULL being false.
    A rule that ``counts`` takes the case out of the clean population."""

    name: str
    when: Column
    counts: bool = True


def further_rules() -> tuple[Rule, Rule]:
    """A close time that cannot be read, and one not after the opening."""
    return (
        Rule("invalid_closed_at", F.col("_closed_text").isNotNull() & F.col("closed_at").isNull()),
        Rule("invalid_resolution_order", F.col("closed_at") <= F.col("created_at")),
    )


def _any_flag(rules: Sequence[Rule]) -> Column:
    """The built-in flags and the rules that count."""
    return reduce(or_, [F.col(r.name) for r in rules if r.counts], any_flag())


def _loaded(run_ts: datetime):
    return ntz(run_ts).alias("_loaded_at")


def stage_customers(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return raw.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.trim("customer_name").alias("customer_name"),
        F.trim(F.upper("region")).alias("region"),
        parse_date(F.col("signup_date")).alias("signup_date"),
        _loaded(run_ts),
    )


def stage_agents(raw: DataFrame, run_ts: datetime) -> DataFrame:
    return raw.filter(F.col("agent_id").isNotNull()).select(
        "agent_id",
        F.trim("agent_name").alias("agent_name"),
        F.trim("team").alias("team"),
        _loaded(run_ts),
    )


def parse_cases(raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Parse each timestamp once, as ISO text or in one of ``formats``; the raw texts stay, because the flags ask about them."""
    return raw.filter(F.col("case_id").isNotNull()).select(
        "case_id",
        parse_timestamp(F.col("created_at"), formats).alias("created_at"),
        parse_timestamp(F.col("closed_at"), formats).alias("closed_at"),
        "customer_id",
        "agent_id",
        F.trim("category").alias("category"),
        F.trim("priority").alias("priority"),
        F.trim("status").alias("status"),
        F.col("created_at").alias("_created_text"),
        F.col("closed_at").alias("_closed_text"),
    )


def with_resolution(parsed: DataFrame) -> DataFrame:
    """Hours and bucket of resolved cases that close after they open."""
    measurable = (F.col("status") == RESOLVED_STATUS) & (F.col("closed_at") > F.col("created_at"))
    hours = F.when(measurable, hours_between(F.col("created_at"), F.col("closed_at")))
    return (
        parsed.withColumn("_hours", hours)
        .withColumns(
            {
                "resolution_hours": rounded_hours(F.col("_hours")),
                "resolution_bucket": duration_bucket(F.col("_hours")),
            }
        )
        .drop("_hours")
    )


def orphan_keys(raw: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The distinct keys the cases use and no parent has.

    Only this narrow column is shuffled, and counted per key before it is. Written as a table
    of known size, it lets Spark broadcast the orphans, which are few, where the whole parent
    would be too large and every case would have to be shuffled to meet it.
    """
    return unmatched_counts(raw, fk, parent, pk).filter(F.col("fk").isNotNull()).select("fk")


def with_orphans(
    parsed: DataFrame, customer_orphans: DataFrame, agent_orphans: DataFrame
) -> DataFrame:
    """Mark the cases whose customer or agent is missing or not staged."""
    customers = customer_orphans.select(F.col("fk").alias("_customer"))
    agents = agent_orphans.select(F.col("fk").alias("_agent"))
    found = lookup_join(parsed, customers, "customer_id", "_customer", "case_id")
    found = lookup_join(found, agents, "agent_id", "_agent", "case_id")
    return found.withColumns(
        {
            "dq_flag_orphan_customer": F.col("customer_id").isNull() | F.col("_customer").isNotNull(),
            "dq_flag_orphan_agent": F.col("agent_id").isNull() | F.col("_agent").isNotNull(),
        }
    ).drop("_customer", "_agent")


def with_current_orphans(
    staged: DataFrame, customer_orphans: DataFrame, agent_orphans: DataFrame, rules: Sequence[Rule] = ()
) -> DataFrame:
    """Staged cases with their orphan flags looked up again; parents may have arrived since."""
    bare = staged.drop("dq_flag_orphan_customer", "dq_flag_orphan_agent", "has_any_dq_flag")
    found = with_orphans(bare, customer_orphans, agent_orphans)
    return found.withColumn("has_any_dq_flag", _any_flag(rules)).select(*staged.columns)


def with_flags(parsed: DataFrame) -> DataFrame:
    """The three flags of the row itself; status is trusted over the timestamps."""
    flags = {
        "dq_flag_closed_no_timestamp": (F.col("status") == RESOLVED_STATUS)
        & F.col("_closed_text").isNull(),
        "dq_flag_status_ts_mismatch": F.col("status").isin(*UNRESOLVED_STATUSES)
        & F.col("_closed_text").isNotNull(),
        "dq_flag_invalid_created_at": F.col("created_at").isNull(),
    }
    return parsed.withColumns({n: F.coalesce(p, F.lit(False)) for n, p in flags.items()})


def stage_cases(
    raw: DataFrame, customer_orphans: DataFrame, agent_orphans: DataFrame, run_ts: datetime,
    rules: Sequence[Rule] = (), formats: Sequence[str] = (),
) -> DataFrame:
    """Staged cases; the orphans come from :func:`orphan_keys`. Each of ``rules`` adds a flag."""
    parsed = with_orphans(parse_cases(raw, formats), customer_orphans, agent_orphans)
    flagged = with_flags(with_resolution(parsed))
    flagged = flagged.withColumns({r.name: F.coalesce(r.when, F.lit(False)) for r in rules}) if rules else flagged
    flagged = flagged.withColumn("has_any_dq_flag", _any_flag(rules))
    return flagged.select(
        "case_id",
        "created_at",
        "closed_at",
        "customer_id",
        "agent_id",
        "category",
        "priority",
        "status",
        "resolution_hours",
        "resolution_bucket",
        *DQ_FLAGS,
        *[r.name for r in rules],
        "has_any_dq_flag",
        _loaded(run_ts),
    )


def extended_flags(raw: DataFrame) -> DataFrame:
    """The flags of :func:`further_rules` alone, by case."""
    flags = [F.coalesce(r.when, F.lit(False)).alias(r.name) for r in further_rules()]
    return parse_cases(raw).select("case_id", *flags)
