import pytest

from tests.conftest import SMALL, spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):  # noqa: F811
    """A function from (doc_id, text) pairs to a documents table with a clashing extra column."""

    def make(rows, extra="ids string, spans string, fp long, key string"):
        table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        return table.selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in extra.split(", ")])

    return make


@pytest.fixture
def small():
    return SMALL
