"""Every registered query against its expected SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.conftest import SMALL
from caseflow.plans.registry import all_queries
from caseflow.verification import oracle
from caseflow.verification.compare import difference, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")

QUERIES = all_queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def scan_of(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1
    return scans[0]


def read_columns(scan):
    return {c.split(":")[0] for c in scan.split("ReadSchema: struct<")[1].split(">")[0].split(",") if ":" in c}


def test_reports_read_only_their_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert read_columns(scan_of(spark, "closure_by_priority")) == {"priority", "is_resolved"}
        scan = scan_of(spark, "resolution_by_team")
        assert read_columns(scan) == {"team", "resolution_hours", "is_resolved", "has_any_dq_flag"}
        pushed = scan.split("PushedFilters: [")[1].split("]")[0]
        assert "EqualTo(has_any_dq_flag,true)" in pushed and "IsNotNull(resolution_hours)" in pushed
        # a filter above the aggregate reaches the scan
        assert "EqualTo(category,Account)" in scan_of(spark, "segment_drilldown")
        assert "created_month" in scan_of(spark, "pruned_date_range").split("PartitionFilters: [")[1].split("]")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_lazy_filter_prunes_expired_versions(spark):
    from caseflow.operators.dims import current
    from caseflow.plans.warehouse import warehouse

    plan = current(warehouse(spark, SMALL).dim_customer)._jdf.queryExecution().executedPlan().toString()
    assert "is_current" in plan.split("PartitionFilters: [")[1].split("]")[0]
