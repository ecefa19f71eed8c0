"""Hot and missing keys, with every join shuffled as it is beyond the broadcast threshold."""

import pytest
from pyspark.sql import functions as F

from caseflow.operators import dims
from caseflow.operators.fact import clustered_by_month
from caseflow.operators.joins import lookup_join, unmatched_counts
from caseflow.sources import casemodel
from tests.conftest import rows

N = 60_000


@pytest.fixture
def small_skew_limits(no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        no_broadcast.conf.set(name, value)
    yield no_broadcast
    for name in settings:
        no_broadcast.conf.unset(name)


def cases(spark, key):
    return spark.range(0, N, 1, 8).select(F.concat(F.lit("C"), "id").alias("case_id"), key.alias("key"))


def customers(spark):
    return spark.range(2000).select(F.concat(F.lit("k"), "id").alias("customer"), F.col("id").alias("sk"))


def test_a_hot_key_is_split(small_skew_limits):
    spark = small_skew_limits
    hot = F.when(F.col("id") % 3 == 0, "k1").otherwise(F.concat(F.lit("k"), F.col("id") % 2500))
    joined = lookup_join(cases(spark, hot), customers(spark), "key", "customer", "case_id")
    found = joined.select("case_id", "sk").collect()
    assert len(found) == len({r.case_id for r in found}) == N
    plan = joined.select("case_id", "sk")
    plan.collect()
    assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    missing = sum(1 for i in range(N) if i % 3 and i % 2500 >= 2000)
    assert sum(r.sk is None for r in found) == missing


def test_missing_keys_are_spread(no_broadcast):
    spark = no_broadcast
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        none = F.when(F.col("id") % 2 == 0, F.concat(F.lit("k"), F.col("id") % 2000))
        joined = lookup_join(cases(spark, none), customers(spark), "key", "customer", "case_id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == N and len(sizes) == 8 and max(sizes) < N / 4
        assert joined.filter("sk is null").count() == N // 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_lookup_key_like_a_filler_never_matches(spark):
    fillers = spark.range(5000).select(F.concat(F.lit("none-"), "id").alias("customer"), F.col("id").alias("sk"))
    joined = lookup_join(cases(spark, F.lit(None).cast("string")), fillers, "key", "customer", "case_id")
    assert joined.filter("sk is not null").count() == 0


def test_child_keys_are_counted_before_the_join(no_broadcast):
    spark = no_broadcast
    child = cases(spark, F.when(F.col("id") % 3 == 0, "k9999").when(F.col("id") % 3 == 1, "k1"))
    counted = unmatched_counts(child, "key", customers(spark), "customer")
    assert rows(counted) == [("k9999", N // 3), (None, N // 3)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("partial_count")


def test_numbering_is_spread_over_buckets(spark):
    ids = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("id"))
    numbered = dims.number_rows(ids, "id", "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_bucket" in plan
    assert numbered.select("n").distinct().count() == 4000


def test_a_hot_month_is_written_by_many_tasks(small_skew_limits, tmp_path):
    spark = small_skew_limits
    # about a third of the hot month, and more than any other month
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    key = F.when(F.col("id") % 3 == 0, 20250101 + F.col("id") % 28).otherwise(20240101 + (F.col("id") % 12) * 100)
    fact = spark.range(0, N, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"), key.cast("int").alias("created_date_key")
    )
    clustered_by_month(fact).write.partitionBy("created_month").parquet(f"{tmp_path}/fact")
    hot = len(list((tmp_path / "fact" / "created_month=202501").glob("*.parquet")))
    others = [len(list(f.glob("*.parquet"))) for f in (tmp_path / "fact").glob("created_month=2024*")]
    assert hot >= 3 and hot > max(others)
    assert spark.read.parquet(f"{tmp_path}/fact").count() == N


def test_lines_are_not_combined_before_their_shuffle(no_broadcast, tmp_path):
    """Orders with few lines that lie apart: groups held while reading would spill on a large table."""
    spark = no_broadcast
    keys = [1, 2, 1, None, 2, None, 4]
    lines = [(k, 10 - i, f"1998-01-0{i + 1}") for i, k in enumerate(keys)] + [(1, None, None)]
    orders = [(1, 5, "F"), (2, 5, "O"), (2, 5, "O"), (3, 6, "P"), (None, 6, "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, ship string").selectExpr(
        "l_orderkey", "l_suppkey", "cast(ship as timestamp) as l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").selectExpr(
        "*", "timestamp'1997-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    found = casemodel.source_cases(spark, str(tmp_path))
    lines_side = found._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(l_orderkey")
    assert len(lines_side) == 2 and "Aggregate" not in lines_side[1]
    assert rows(found, "case_id", "agent_id", "closed_at") == [
        ("C1", "AG8", "1998-01-03T07:00:00"), ("C2", "AG6", "1998-01-05T14:00:00"), ("C2", "AG6", "1998-01-05T14:00:00"),
        ("C3", None, None), (None, None, None),
    ]
