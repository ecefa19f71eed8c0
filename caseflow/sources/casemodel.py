"""The case model over the order tables: every order is a case, with repeatable damage so
that each data-quality branch has rows. All outputs are text, as a landing file holds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.time import iso_text

# Names the case model gives to the coded columns.
PRIORITY_NAMES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
CATEGORY_NAMES = ("Technical", "Account", "Billing", "Other")
TEAM_NAMES = ("Billing", "Tier 1", "Tier 2", "Escalations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _pick(index: Column, names) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index % len(names) + 1).cast("int"))


def source_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shuffle of the lines; the join then reuses their partitioning.

    An order has few lines and they lie far apart, so combining them as they are read would hold about as many
    groups as rows, and spill them, before any are left out. They are shuffled as they come and combined by key.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_shipdate", "l_suppkey")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("ship"), F.min("l_suppkey").alias("supp"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    k = F.col("o_orderkey")
    opened = F.col("o_orderdate") + _hours(k % 24)
    priority = F.lit("Unspecified")
    for code, name in PRIORITY_NAMES.items():
        priority = F.when(F.col("o_orderpriority") == code, name).otherwise(priority)
    return orders.join(lines, k == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("C"), k).alias("case_id"),
        F.when(k % 101 == 0, "not-a-date").otherwise(iso_text(opened)).alias("created_at"),
        F.when(k % 23 == 0, "")
        .when(F.col("ship").isNull(), None)
        .when(k % 5 == 0, iso_text(F.col("o_orderdate") + _hours(k % 24 + k % 160)))
        .otherwise(iso_text(F.col("ship") + _hours(k * 7 % 24)))
        .alias("closed_at"),
        F.concat(F.when(k % 53 == 0, "CU-X").otherwise("CU"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("AG"), F.col("supp")).alias("agent_id"),
        _pick(k, CATEGORY_NAMES).alias("category"),
        priority.alias("priority"),
        F.when(F.col("o_orderstatus") == "F", " Closed ")
        .when(F.col("o_orderstatus") == "O", "Open")
        .when(k % 2 == 0, "In Progress")
        .otherwise("On Hold")
        .alias("status"),
    )


def source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    region = F.col("r_name")
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("CU"), k).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.when(k % 2 == 0, F.concat(F.lit("  "), F.lower(region)))
            .otherwise(F.concat(region, F.lit(" ")))
            .alias("region"),
            F.when(k % 97 == 0, "bad")
            .otherwise(F.date_add(F.lit("1994-01-01").cast("date"), (k % 1500).cast("int")).cast("string"))
            .alias("signup_date"),
        )
    )


def source_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("AG"), F.col("s_suppkey")).alias("agent_id"),
        F.col("s_name").alias("agent_name"),
        _pick(F.col("s_nationkey"), TEAM_NAMES).alias("team"),
    )
