"""Quarters and look-back ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quarter_bounds(year: Column, quarter: Column) -> tuple[Column, Column]:
    """First and last day of a quarter."""
    first = F.make_date(year, quarter * 3 - 2, F.lit(1))
    return first, F.date_sub(F.add_months(first, 3), 1)


def quarters_in_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``year, quarter, first_day, last_day`` of every quarter that the range touches."""
    step = F.explode(F.sequence(F.to_date(F.date_trunc("quarter", F.lit(start).cast("date"))), F.lit(end).cast("date"), F.expr("interval 3 months"))).alias("d")
    days = spark.range(1).select(step).select(F.year("d").alias("year"), F.quarter("d").alias("quarter"))
    first, last = quarter_bounds(F.col("year"), F.col("quarter"))
    return days.select("year", "quarter", first.alias("first_day"), last.alias("last_day"))


def lookback(days: int) -> tuple[Column, Column]:
    """From twice as many calendar days ago, so that as many trading days fit, to today."""
    return F.date_sub(F.current_date(), 2 * days), F.current_date()
