"""Hourly and daily view profiles, and the calendar they are read against."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS_PER_DAY = 24


def until(df: DataFrame, last_day: datetime.date, date_col: str = "file_date") -> DataFrame:
    """Rows up to and including a day."""
    return df.where(F.col(date_col) <= F.lit(last_day))


def hourly_profile(df: DataFrame, first_n: int | None = None) -> DataFrame:
    """Views per day and hour in order; ``first_n`` keeps the first hours of the series."""
    hours = (
        df.groupBy("file_date", F.substring("file_time", 1, 2).cast("int").alias("hour"))
        .agg(F.sum("count_views").alias("views_hour"))
        .orderBy("file_date", "hour")
    )
    return hours if first_n is None else hours.limit(first_n)


def daily_profile(df: DataFrame) -> DataFrame:
    """Views per day, and spread evenly over its hours, in order."""
    return (
        df.groupBy("file_date")
        .agg(F.sum("count_views").alias("views_day"))
        .withColumn("views_day_per_hour", F.col("views_day") / F.lit(float(HOURS_PER_DAY)))
        .orderBy("file_date")
    )


def daily_vs_hourly(df: DataFrame) -> DataFrame:
    """Population variance of hourly views and of daily views / 24, as one row.

    Days are summed from hours, so page views are aggregated once.
    """
    hours = hourly_profile(df)
    days = hours.groupBy("file_date").agg((F.sum("views_hour") / F.lit(float(HOURS_PER_DAY))).alias("level"))
    series = hours.select(F.lit("hourly").alias("series"), F.col("views_hour").cast("double").alias("level")).unionByName(
        days.select(F.lit("daily").alias("series"), "level")
    )
    hourly, daily = F.col("series") == "hourly", F.col("series") == "daily"
    return series.agg(
        F.count_if(hourly).alias("n_hours"),
        F.count_if(daily).alias("n_days"),
        F.var_pop(F.when(hourly, F.col("level"))).alias("var_hourly"),
        F.var_pop(F.when(daily, F.col("level"))).alias("var_daily"),
    )


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def weekend_spine(spark: SparkSession, start: datetime.date, end: datetime.date) -> DataFrame:
    """Every day of a period with a weekend flag."""
    return _spine(spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last")))


def weekend_spine_of(df: DataFrame, date_col: str = "file_date") -> DataFrame:
    """The same for the period a table covers."""
    return _spine(df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last")))


def _spine(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.withColumn("is_weekend", is_weekend(F.col("day")))
