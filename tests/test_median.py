import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseflow.operators.median import aggregate_with_median
from tests.conftest import rows


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for _ in range(rng.randint(1, 600)):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        value = None if rng.random() < 0.2 else Decimal(rng.randint(0, 40) * rng.choice([1, 7, 333])) / 100
        data.append((key, value, rng.random() < 0.5))
    df = spark.createDataFrame(data, "k string, v decimal(10,2), f boolean")
    got = {
        r.k: (r.n_values, r.sum_value, r.min_value, r.max_value, None if r.median is None else float(r.median), r.all, r.f)
        for r in aggregate_with_median(df, ["k"], F.col("v"), {"all": F.lit(True), "f": F.col("f")}).collect()
    }
    want = {}
    for key in {d[0] for d in data}:
        group = [d for d in data if d[0] == key]
        vs = [d[1] for d in group if d[1] is not None]
        want[key] = (
            len(vs), sum(vs) if vs else None, min(vs, default=None), max(vs, default=None),
            float(statistics.median(vs)) if vs else None, len(group), sum(d[2] for d in group),
        )
    assert got == want


def test_rows_are_counted_before_they_are_gathered(spark):
    df = spark.range(1000).select(
        F.lit("x").alias("k"), F.lit(Decimal("1.25")).cast("decimal(10,2)").alias("v")
    )
    out = aggregate_with_median(df, ["k"], F.col("v"), {})
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the partial count sits below the first exchange, the window above it
    assert plan.index("Window") < plan.rindex("Exchange") < plan.rindex("partial_count")
    assert rows(out, "n_values") == [(1000,)]
