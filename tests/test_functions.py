from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseflow.functions.measures import mean_of, pct
from caseflow.functions.text import clean_strings
from caseflow.functions.time import (
    date_key,
    duration_bucket,
    hours_between,
    iso_text,
    key_date,
    parse_date,
    parse_timestamp,
    rounded_hours,
    seconds_between,
)
from tests.conftest import rows


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_null_tokens_are_read_after_trimming(spark):
    texts = ["NULL", "null", "\\N", "", "  ", " NULL ", " x ", "Null", None, "\tx"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    cleaned = [r.s for r in clean_strings(df).orderBy("i").collect()]
    assert cleaned == [None, None, None, None, None, None, "x", "Null", None, "\tx"]


def test_timestamps_parse_or_become_null(spark):
    texts = [
        "2025-03-01T10:20:30.144462",
        "2025-03-01T10:20:30",
        "2025-03-01 10:20:30",
        "2025-03-01",
        "not-a-date",
        "2025",
        "1735689600",
        "2025-02-30T00:00:00",
        "2025-03-01T25:00:00",
        None,
    ]
    got = values(spark, texts, parse_timestamp(F.col("s")))
    assert got == [
        datetime(2025, 3, 1, 10, 20, 30, 144462),
        datetime(2025, 3, 1, 10, 20, 30),
        datetime(2025, 3, 1, 10, 20, 30),
        datetime(2025, 3, 1),
        None, None, None, None, None, None,
    ]


def test_dates_parse_or_become_null(spark):
    got = values(spark, ["2024-02-29", "2023-02-29", "bad", "2024", None], parse_date(F.col("s")))
    assert [str(g) if g else None for g in got] == ["2024-02-29", None, None, None, None]


@pytest.mark.parametrize(
    "start, end, seconds",
    [
        ("2025-01-01 00:00:00.9", "2025-01-01 00:00:01.1", 1),
        ("2025-01-01 00:00:00.1", "2025-01-01 00:00:00.9", 0),
        ("2025-01-01 00:00:00.9", "2025-01-01 00:00:02.1", 2),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00.5", 1),
        # the hour that a zone with clock changes skips still counts
        ("2025-03-09 01:00:00", "2025-03-09 04:00:00", 3 * 3600),
    ],
)
def test_second_boundaries(spark, start, end, seconds):
    df = spark.sql(f"select timestamp_ntz'{start}' a, timestamp_ntz'{end}' b")
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == seconds


@pytest.mark.parametrize(
    "seconds, hours, bucket",
    [
        (18, "0.01", "<24h"),  # 0.005 h rounds away from zero
        (17, "0.00", "<24h"),
        (24 * 3600 - 1, "24.00", "<24h"),  # the bucket looks at unrounded hours
        (24 * 3600, "24.00", "1-3 days"),
        (72 * 3600 - 1, "72.00", "1-3 days"),
        (72 * 3600, "72.00", ">3 days"),
    ],
)
def test_hours_and_buckets(spark, seconds, hours, bucket):
    df = spark.sql(
        "select timestamp_ntz'2025-01-01 00:00:00' a,"
        f" timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}) b"
    )
    h = hours_between(F.col("a"), F.col("b"))
    assert tuple(df.select(rounded_hours(h), duration_bucket(h)).first()) == (Decimal(hours), bucket)


def test_null_hours_have_no_bucket(spark):
    df = spark.sql("select cast(null as decimal(20,6)) h")
    assert df.select(duration_bucket(F.col("h"))).first()[0] is None


def test_date_key_and_iso_text(spark):
    df = spark.sql("select timestamp_ntz'2024-02-29 23:59:59' t, cast(null as timestamp_ntz) n")
    assert tuple(df.select(date_key(F.col("t")), date_key(F.col("n")), iso_text(F.col("t"))).first()) == (
        20240229, None, "2024-02-29T23:59:59",
    )


def test_key_date_is_the_inverse(spark):
    df = spark.sql("select explode(array(20240229, 20251231, 19950101, null)) k")
    back = df.select("k", date_key(key_date(F.col("k"))).alias("again"))
    assert all(r.k == r.again for r in back.collect())


def test_rates_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 16), (1, 8), (1, 0), (7, 14)], "p long, w long")
    got = rows(df.select(pct(F.col("p"), F.col("w"), 1)))
    assert got == [(12.5,), (50.0,), (6.3,), (None,)]  # 6.25 -> 6.3, nothing over zero


def test_mean_is_exact_at_ties(spark):
    df = spark.createDataFrame([(Decimal("0.20"),), (Decimal("0.50"),), (None,)], "v decimal(10,2)")
    assert df.agg(mean_of(F.col("v"))).first()[0] == 0.4  # 0.35


def test_declared_formats(spark):
    from caseflow.functions.time import parse_timestamp, vote_formats

    texts = ["2024-01-02T03:04:05", "31/12/2023 23:59:58", "01/02/2024 03:04:05", "1/2/2024 3:04:05", "31/02/2024 00:00:00", "5-mar-2024", "5-xyz-2024", "10/03/2024 02:30:00", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    declared = ("MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "dd-MMM-yyyy")
    order = vote_formats(df, ["t"], declared)
    assert order == ["dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd-MMM-yyyy"]
    got = [r[0] for r in df.select(parse_timestamp(F.col("t"), order).cast("string")).collect()]
    assert got == [
        "2024-01-02 03:04:05", "2023-12-31 23:59:58", "2024-02-01 03:04:05", "2024-02-01 03:04:05", None,
        "2024-03-05 00:00:00", None, "2024-03-10 02:30:00", None, None,
    ]
    assert vote_formats(df.limit(0), ["t"], declared) == list(declared) and vote_formats(df, ["t"], ()) == []
    for wrong in ("yyyy", "dd/dd/yyyy", "MM/MMM/dd/yyyy"):
        with pytest.raises(ValueError):
            parse_timestamp(F.col("t"), [wrong])


def test_sketches_merge(spark):
    from caseflow.operators import sketches

    rows = spark.range(60_000).selectExpr(
        "cast(if(id % 11 = 0, null, 202401 + id % 6) as int) as created_month", "concat('r', id % 2) as region",
        "if(id % 7 = 0, null, concat('a', id % 1500)) as agent_name", "'Closed' as status", "id % 5 < 4 as is_resolved",
        "false as has_any_dq_flag", "cast(id % 997 as decimal(10,2)) as resolution_hours",
    )
    kept = sketches.month_sketches(rows, ["region"])
    got = {r["region"]: r for r in sketches.range_estimates(kept, 202402, 202404, ["region"]).collect()}
    exact = rows.filter("created_month between 202402 and 202404").toPandas()
    for region, part in exact.groupby("region"):
        hours = part[part.is_resolved].resolution_hours.astype(float)
        assert got[region]["total_cases"] == len(part) and got[region]["timed_cases"] == len(hours)
        assert abs(got[region]["agent_count"] - part.agent_name.nunique()) <= sketches.AGENT_ERROR * part.agent_name.nunique()
        assert abs((hours <= got[region]["median_hours"]).mean() - 0.5) <= sketches.RANK_ERROR
    untimed = sketches.month_sketches(rows.withColumn("resolution_hours", F.lit(None).cast("decimal(10,2)")), ["region"])
    assert {r["median_hours"] for r in sketches.range_estimates(untimed, 202401, 202406, ["region"]).collect()} == {None}
    assert sketches.range_estimates(kept.limit(0), 202401, 202406, ["region"]).count() == 0
