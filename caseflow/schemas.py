"""Declared schemas, value domains and reference rows of the case model."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    """An all-string landing schema: type errors must never fail a load."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_CASES = strings(
    "case_id", "created_at", "closed_at", "customer_id", "agent_id", "category", "priority", "status"
)
RAW_CUSTOMERS = strings("customer_id", "customer_name", "region", "signup_date")
RAW_AGENTS = strings("agent_id", "agent_name", "team")

# --- fixed values -----------------------------------------------------------
# Tokens that mean "no value" in a landed text field.
NULL_TOKENS = ("NULL", "null", "", "\\N")

# Status that resolves a case, and the statuses that contradict a close time.
RESOLVED_STATUS = "Closed"
UNRESOLVED_STATUSES = ("Open", "On Hold", "In Progress")

# Resolution buckets: label and exclusive upper bound in hours.
BUCKETS = (("<24h", 24), ("1-3 days", 72), (">3 days", None))

# Longest text each landed column may hold.
CASE_WIDTHS = {
    "case_id": 10, "created_at": 50, "closed_at": 50, "customer_id": 10, "agent_id": 10,
    "category": 50, "priority": 20, "status": 20,
}
CUSTOMER_WIDTHS = {"customer_id": 10, "customer_name": 100, "region": 50, "signup_date": 20}
AGENT_WIDTHS = {"agent_id": 10, "agent_name": 100, "team": 50}

# Accepted values of the enumerated columns.
ACCEPTED_PRIORITIES = ("Low", "Medium", "High", "Urgent")
ACCEPTED_STATUSES = ("Open", "Closed", "In Progress", "On Hold")
ACCEPTED_CATEGORIES = ("Technical", "Account", "Billing", "Other")
ACCEPTED_TEAMS = ("Billing", "Tier 1", "Tier 2", "Escalations")

# SLA policy: priority and target resolution hours.
SLA_TARGETS = (
    ("Urgent", Decimal("8.0")),
    ("High", Decimal("24.0")),
    ("Medium", Decimal("72.0")),
    ("Low", Decimal("120.0")),
)

# valid_to of the open dimension version.
OPEN_END = date(9999, 12, 31)

# Default calendar span.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)
# ----------------------------------------------------------------------------

SLA_SCHEMA = T.StructType(
    [
        T.StructField("priority", T.StringType(), False),
        T.StructField("target_resolution_hrs", T.DecimalType(10, 1), False),
    ]
)

HOURS = T.DecimalType(10, 2)

DQ_FLAGS = (
    "dq_flag_closed_no_timestamp",
    "dq_flag_status_ts_mismatch",
    "dq_flag_invalid_created_at",
    "dq_flag_orphan_customer",
    "dq_flag_orphan_agent",
)

CUSTOMER_ATTRIBUTES = ("customer_name", "region", "signup_date")
AGENT_ATTRIBUTES = ("agent_name", "team")
