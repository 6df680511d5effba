"""Returns from prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.scalars import ratio
from quillon.sources.schemas import DATE, ID


def daily_returns(prices: DataFrame, price: str = "ADJUSTED_PRICE", pad: bool = False) -> DataFrame:
    """``SECURITY_ID, DATE, ONE_DAY_PCT``: each price over the security's previous row, less one.

    A security's first row, missing prices and a previous price of zero give no return. ``pad`` carries the last known
    price over missing ones. Without an id column the whole table is one series.
    """
    key = [ID] if ID in prices.columns else []
    w = Window.partitionBy(*key).orderBy(DATE)
    px = F.last(price, ignorenulls=True).over(w) if pad else F.col(price)
    priced = prices.select(*key, DATE, px.alias("_px"))
    out = priced.select(*key, DATE, (ratio(F.col("_px"), F.lag("_px").over(w)) - 1).alias("ONE_DAY_PCT"))
    return out.filter(F.col("ONE_DAY_PCT").isNotNull())
