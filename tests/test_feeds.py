"""What queries over several runs read, and what the reconciliation shuffles."""

import os

import pytest

from caseflow.plans import checks
from caseflow.plans import warehouse as wh
from tests.conftest import SMALL, rows


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_stored_cases_are_derived_once(spark):
    feeds = wh.stored_feeds(spark, SMALL)
    plan = feeds["cases"]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lineitem" not in plan
    assert rows(feeds["cases"]) == rows(wh.source_feeds(spark, SMALL)["cases"])


def test_recomputation_joins_results_not_texts(spark):
    text = "case_id string, created_at string, closed_at string, customer_id string, agent_id string, category string, priority string, status string"
    cases = [
        ("C1", "2000-01-01T00:00:00", "2000-01-01T06:00:00", "U1", "A1", "x", " High ", "Closed"),
        ("C2", "2000-01-01T00:00:00", None, "U1", "A1", "x", "Low", " Closed "),
        ("C3", "no", "2000-01-01", None, "A1", "x", "Low", "Open"),
        (None, "2000-01-01", None, "U1", "A1", "x", "Low", "Open"),
    ]
    found = checks.recomputed_cases(
        spark.createDataFrame(cases, text),
        spark.createDataFrame([("U1", " east")], "customer_id string, region string"),
        spark.createDataFrame([("A1", "Tier 1 ")], "agent_id string, team string"),
    )
    assert [tuple(map(str, r)) for r in rows(found)] == [
        ("High", "EAST", "Tier 1", "True", "False", "6.000000"),
        ("Low", "EAST", "Tier 1", "True", "True", "None"),
        ("Low", "None", "Tier 1", "False", "True", "None"),
    ]

    def joined(node):
        if node.nodeName() == "Join":
            yield node.children().apply(0).output().mkString(" ")
        for i in range(node.children().size()):
            yield from joined(node.children().apply(i))

    sides = list(joined(found._jdf.queryExecution().optimizedPlan()))
    assert len(sides) == 2 and not any(c in side for side in sides for c in ("closed_at", "case_id", "status"))
