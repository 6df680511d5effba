"""Amounts in dollars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.sources.schemas import DATE

RATE = "EXCHANGE_RATE_TO_USD"


def to_usd_dated(df: DataFrame, rates: DataFrame, amount: str, currency: str = "CURRENCY") -> DataFrame:
    """``df`` with ``amount`` times the day's rate; 1 for dollars and where no rate is known."""
    known = rates.select(DATE, F.col("CURRENCY").alias(currency), F.col(RATE).alias("_rate")).dropDuplicates([DATE, currency])
    rate = F.when(F.col(currency) == "USD", 1.0).otherwise(F.coalesce("_rate", F.lit(1.0)))
    return df.join(known, [DATE, currency], "left").withColumn(amount, F.col(amount) * rate).drop("_rate")


def to_usd_latest(df: DataFrame, rates: DataFrame, amount: str, currency: str = "CURRENCY") -> DataFrame:
    """``df`` with ``amount`` times its currency's latest rate; unchanged without one."""
    last = rates.groupBy(F.col("CURRENCY").alias(currency)).agg(F.max_by(RATE, DATE).alias("_rate"))
    rate = F.when(F.col(currency) == "USD", 1.0).otherwise(F.coalesce("_rate", F.lit(1.0)))
    return df.join(last, currency, "left").withColumn(amount, F.col(amount) * rate).drop("_rate")
