"""Null-aware arithmetic. Null is the only missing value; division by zero gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a, b)


def clipped(c: Column, low: Column, high: Column) -> Column:
    """``c`` within its bounds; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def mean_of(*columns: str) -> Column:
    """Mean of the non-null columns of a row; null if all are."""
    some = F.filter(F.array(*columns), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(some, F.lit(0.0), lambda a, x: a + x), F.size(some))


def iso(date: str) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def dummy_name(prefix: str, value: str) -> str:
    return f"{prefix}_{value.replace(' ', '_')}"
