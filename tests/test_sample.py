"""Published figures of the 200-case sample, where its three CSV files are at hand."""

import os
from datetime import datetime, timedelta

import pytest

from caseflow import Warehouse
from caseflow.operators import contracts
from caseflow.operators.fact import FACT_COLUMNS
from caseflow.operators.upsert import changes
from caseflow.plans import analytics, checks, reporting
from tests.conftest import rows

FOLDER = os.environ.get("CASEFLOW_SAMPLE_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="CASEFLOW_SAMPLE_DIR is not set")
TS = datetime(2026, 3, 1)


def run(spark, root, run_id=0):
    paths = {n: f"{FOLDER}/{n}.csv" for n in ("cases", "customers", "agents")}
    return Warehouse.from_csv(spark, paths, root, TS + timedelta(days=run_id), run_id=run_id)


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    return run(spark, str(tmp_path_factory.mktemp("sample")))


def test_flags(w):
    assert tuple(contracts.dq_summary(w.stg_cases).first()) == (9, 123, 0, 0, 0, 132, 200)


def test_resolution(w):
    assert tuple(analytics.overall_resolution(w.fact).first()) == (96.8, 4.03, 38)
    by_priority = analytics.resolution_by_priority(w.fact)
    assert rows(by_priority, "priority", "resolved_cases", "avg_resolution_hours", "median_resolution_hours") == [
        ("High", 11, 53.7, 31.0), ("Low", 9, 126.3, 189.0), ("Medium", 13, 113.5, 106.0), ("Urgent", 5, 94.8, 80.0),
    ]
    assert rows(analytics.resolution_by_team(w.fact), "team", "avg_resolution_hours") == [
        ("Billing", 107.5), ("Escalations", 121.8), ("Tier 1", 147.6), ("Tier 2", 60.9),
    ]
    assert rows(analytics.resolution_by_category(w.fact), "category", "avg_resolution_hours") == [
        ("Account", 97.1), ("Billing", 164.8), ("Other", 89.3), ("Technical", 70.2),
    ]
    assert rows(analytics.resolution_distribution(w.fact), "resolution_bucket", "resolved_cases") == [
        ("1-3 days", 10), ("<24h", 5), (">3 days", 23),
    ]


def test_volume_and_closure(w):
    assert rows(analytics.region_volume(w.fact), "region", "total_cases", "closure_rate_pct") == [
        ("APAC", 42, 31.0), ("EUROPE", 47, 27.7), ("LATAM", 62, 19.4), ("NORTH AMERICA", 49, 18.4),
    ]
    assert rows(analytics.closure_by_priority(w.fact), "priority", "closure_rate_pct") == [
        ("High", 23.5), ("Low", 23.8), ("Medium", 30.5), ("Urgent", 14.6),
    ]


def test_sla_and_health(w):
    assert rows(reporting.priority_sla(w.fact, w.sla), "priority", "met_sla", "resolved_clean_cases") == [
        ("High", 4, 11), ("Low", 4, 9), ("Medium", 3, 13), ("Urgent", 0, 5),
    ]
    assert reporting.dq_monitor(w.fact, TS).first().pipeline_healthy
    assert checks.metric_reconciliation(
        w.fact, w.source("cases"), w.source("customers"), w.source("agents")
    ).filter("not ok").count() == 0


def test_layer_counts(w):
    counts = contracts.row_counts({"customers": w.dim_customer, "agents": w.dim_agent, "dates": w.dim_date})
    assert rows(counts) == [("agents", 40), ("customers", 150), ("dates", 4018)]


def test_rerun_changes_nothing(spark, w):
    again = run(spark, w.root, 1)
    kept = [*FACT_COLUMNS, "_loaded_at"]
    assert tuple(changes(w.fact.select(*kept), again.fact.select(*kept), ["case_id"]).first()) == (200, 200, 0)
    assert again.dim_customer.count() == 150
