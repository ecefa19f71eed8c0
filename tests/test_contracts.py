from pyspark.sql import functions as F

from caseflow.operators import contracts
from tests.conftest import rows

import pytest


@pytest.fixture
def child(spark):
    data = [("a", "p1", "x"), ("a", "p9", "y"), ("b", None, "z"), ("c", "p9", None), (None, "p1", " ")]
    return spark.createDataFrame(data, "id string, fk string, v string")


def test_unique(child):
    assert rows(contracts.unique(child, ["id"], "t")) == [("unique", "t.id", 1, False)]
    assert rows(contracts.unique(child, ["id", "fk"], "t")) == [("unique", "t.id+fk", 0, True)]


def test_not_null(child):
    assert rows(contracts.not_null(child, ["id", "v"], "t"), "object", "violations", "ok") == [
        ("t.id", 1, False), ("t.v", 2, False),
    ]


def test_max_length(child):
    found = contracts.max_length(child, {"fk": 1, "v": 1, "id": 5}, "t")
    assert rows(found, "object", "violations", "ok") == [("t.fk", 4, False), ("t.id", 0, True), ("t.v", 0, True)]


def test_unexpected_values(child):
    found = contracts.unexpected_values(child, {"v": ["x", "y", "z"], "id": ["a", "b", "c"]}, "t")
    assert rows(found) == [("t.id", None, 1), ("t.v", " ", 1), ("t.v", None, 1)]


def test_relationship_counts_rows_and_nulls(spark, child):
    parent = spark.createDataFrame([("p1",), ("p2",)], "pk string")
    assert rows(contracts.relationship(child, "fk", parent, "pk", "c", "p"), "violations", "ok") == [(3, False)]
    whole = child.filter(F.col("fk") == "p1")
    assert rows(contracts.relationship(whole, "fk", parent, "pk", "c", "p"), "violations", "ok") == [(0, True)]


def test_row_counts(spark, child):
    got = contracts.expected_row_counts({"t": child, "u": child.limit(0)}, {"t": child, "u": child})
    assert rows(got, "tbl", "actual", "expected", "ok") == [("t", 5, 5, True), ("u", 0, 5, False)]


def test_rows_preserved(child):
    kept = child.filter(F.col("id").isNotNull())
    got = contracts.rows_preserved({"raw": child, "staged": kept, "fact": kept.limit(3)}, "id")
    assert rows(got) == [("fact", 3, 4, False), ("raw", 5, 5, True), ("staged", 4, 4, True)]
