"""Valuation, profitability and growth of each security and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.scalars import ratio
from quillon.sources.schemas import DATE, ID

VALUE = ("EY_NTM", "SY_NTM", "EBITDA_Y_NTM", "EY_LTM", "SY_LTM")
PROFITABILITY = ("EBITDA_MARGIN", "GROSS_MARGIN")
GROWTH = ("EPS_GROWTH", "SALES_GROWTH")


def _positive(*names: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & (F.coalesce(F.col(n), F.lit(1.0)) > 0)
    return out


def value_yields(price: str = "ADJUSTED_PRICE") -> dict[str, Column]:
    """Forward and trailing yields; earnings and EBITDA must be positive, sales need not be."""
    over = lambda n: ratio(n, price)
    masked = lambda n: F.when(F.col(n) > 0, over(n))
    return {"EY_NTM": masked("EPS_NTM"), "SY_NTM": over("SALES_NTM"), "EBITDA_Y_NTM": masked("EBITDA_NTM"), "EY_LTM": masked("EPS_LTM"), "SY_LTM": over("SALES_LTM")}


def margins() -> dict[str, Column]:
    """EBITDA and gross margin; null where sales, or for the gross one costs, aren't positive."""
    return {"EBITDA_MARGIN": F.when(_positive("SALES_LTM"), ratio("EBITDA_LTM", "SALES_LTM")), "GROSS_MARGIN": F.when(_positive("SALES_LTM", "COGS_LTM"), 1 - ratio("COGS_LTM", "SALES_LTM"))}


def growth_rates() -> dict[str, Column]:
    """Forward over trailing, less one; null where the trailing figure isn't positive."""
    rate = lambda a, b: F.when(F.col(b) > 0, ratio(a, b) - 1)
    return {"EPS_GROWTH": rate("EPS_NTM", "EPS_LTM"), "SALES_GROWTH": rate("SALES_NTM", "SALES_LTM")}


def characteristics(fundamentals: DataFrame, universe: DataFrame, prices: DataFrame) -> DataFrame:
    """``SECURITY_ID, DATE, SECTOR, CONTINENT`` and the nine ratios, for rows that all three tables have."""
    one = universe.select(ID, "SECTOR", "CONTINENT").dropDuplicates([ID])
    joined = fundamentals.join(prices.select(ID, DATE, "ADJUSTED_PRICE"), [ID, DATE]).join(one, ID)
    return joined.select(ID, DATE, "SECTOR", "CONTINENT", *[c.alias(n) for n, c in {**value_yields(), **margins(), **growth_rates()}.items()])
