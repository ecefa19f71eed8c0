from datetime import date, datetime
from decimal import Decimal

import pytest

from caseflow.operators import staging
from caseflow.schemas import DQ_FLAGS, RAW_AGENTS, RAW_CASES, RAW_CUSTOMERS
from tests.conftest import rows

TS = datetime(2025, 1, 1)
OPEN, CLOSE = "2025-01-01T00:00:00", "2025-01-02T12:00:00"


@pytest.fixture(scope="module")
def customers(spark):
    raw = spark.createDataFrame(
        [("CU1", " Ann ", " asia ", "2021-02-18"), ("CU2", None, "LATAM", "2021-02-30"), (None, "x", "y", "z")],
        RAW_CUSTOMERS,
    )
    return staging.stage_customers(raw, TS)


@pytest.fixture(scope="module")
def agents(spark):
    return staging.stage_agents(spark.createDataFrame([("AG1", "Bo", " Tier 1 ")], RAW_AGENTS), TS)


def stage(spark, customers, agents, *cases):
    raw = spark.createDataFrame(list(cases), RAW_CASES)
    customer_orphans = staging.orphan_keys(raw, "customer_id", customers, "customer_id")
    agent_orphans = staging.orphan_keys(raw, "agent_id", agents, "agent_id")
    return staging.stage_cases(raw, customer_orphans, agent_orphans, TS)


def case(id="C1", opened=OPEN, closed=CLOSE, customer="CU1", agent="AG1", status="Closed"):
    return (id, opened, closed, customer, agent, " Billing ", "Low", status)


def test_customers_and_agents_are_normalised(customers, agents):
    assert rows(customers, "customer_id", "customer_name", "region", "signup_date") == [
        ("CU1", "Ann", "ASIA", date(2021, 2, 18)),
        ("CU2", None, "LATAM", None),
    ]
    assert rows(agents, "agent_id", "agent_name", "team") == [("AG1", "Bo", "Tier 1")]


def test_clean_case(spark, customers, agents):
    row = stage(spark, customers, agents, case()).first()
    assert (row.resolution_hours, row.resolution_bucket) == (Decimal("36.00"), "1-3 days")
    assert (row.category, row.status, row.has_any_dq_flag) == ("Billing", "Closed", False)


@pytest.mark.parametrize(
    "flag, row",
    [
        ("dq_flag_closed_no_timestamp", case(closed=None)),
        ("dq_flag_status_ts_mismatch", case(status="Open")),
        ("dq_flag_status_ts_mismatch", case(status="On Hold", closed="garbage")),
        ("dq_flag_invalid_created_at", case(opened="garbage")),
        ("dq_flag_invalid_created_at", case(opened=None)),
        ("dq_flag_orphan_customer", case(customer="CU9")),
        ("dq_flag_orphan_customer", case(customer=None)),
        ("dq_flag_orphan_agent", case(agent="AG9")),
    ],
)
def test_each_flag_alone(spark, customers, agents, flag, row):
    staged = stage(spark, customers, agents, row).first()
    assert [f for f in DQ_FLAGS if staged[f]] == [flag] and staged.has_any_dq_flag


def test_all_row_flags_together(spark, customers, agents):
    row = stage(spark, customers, agents, case("C1", "bad", None, "CU9", None)).first()
    assert [row[f] for f in DQ_FLAGS] == [True, False, True, True, True]


@pytest.mark.parametrize("status", [None, "Archived"])
def test_unknown_status_is_neither_flagged_nor_timed(spark, customers, agents, status):
    row = stage(spark, customers, agents, case(status=status)).first()
    assert (row.has_any_dq_flag, row.resolution_hours, row.resolution_bucket) == (False, None, None)


@pytest.mark.parametrize("closed", [OPEN, "2024-12-31T00:00:00", "garbage"])
def test_no_duration_without_a_later_close(spark, customers, agents, closed):
    row = stage(spark, customers, agents, case(closed=closed)).first()
    assert (row.resolution_hours, row.has_any_dq_flag) == (None, False)


def test_orphans_keep_their_duration(spark, customers, agents):
    row = stage(spark, customers, agents, case(customer="CU9")).first()
    assert row.resolution_hours == Decimal("36.00") and row.has_any_dq_flag


def test_rows_are_kept_but_for_a_missing_key(spark, customers, agents):
    staged = stage(spark, customers, agents, case("C1"), case("C2", "bad", "bad", None, None, None), case(None))
    assert rows(staged, "case_id") == [("C1",), ("C2",)]


def test_repeated_lookup_keys_do_not_fan_out(spark, customers, agents):
    staged = stage(spark, customers.unionByName(customers), agents, case())
    assert staged.count() == 1


def test_extended_flags(spark):
    raw = spark.createDataFrame(
        [case("C1", closed="garbage"), case("C2", closed=OPEN), case("C3"), case("C4", closed=None)], RAW_CASES
    )
    assert rows(staging.extended_flags(raw)) == [
        ("C1", True, False), ("C2", False, True), ("C3", False, False), ("C4", False, False),
    ]


def test_null_and_hot_keys_without_broadcast(no_broadcast, customers, agents):
    cases = [case(f"C{i}", customer=None if i % 3 == 0 else "CU1", agent=None) for i in range(300)]
    staged = stage(no_broadcast, customers, agents, *cases)
    counts = staged.groupBy("dq_flag_orphan_customer", "dq_flag_orphan_agent").count()
    assert rows(counts) == [(False, True, 200), (True, True, 100)]
