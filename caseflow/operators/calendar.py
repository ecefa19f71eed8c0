"""Generated calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.time import date_key
from caseflow.schemas import CALENDAR_END, CALENDAR_START


def days(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day between two date columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(start, end)).alias("full_date"))


def date_spine(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    return days(spark.range(1), F.lit(start), F.lit(end))


def calendar(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    weekend = F.dayofweek(d).isin(1, 7)
    return spine.select(
        date_key(d).alias("date_key"),
        d,
        F.dayname(d).alias("day_of_week"),
        (F.dayofweek(d) - 1).alias("day_of_week_num"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.monthname(d).alias("month_name"),
        F.quarter(d).alias("quarter_num"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("quarter_label"),
        F.year(d).alias("year_num"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
    )


def calendar_bounds(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(
        F.min("date_key").alias("min_date_key"),
        F.max("date_key").alias("max_date_key"),
        F.count("*").alias("total_days"),
    )
