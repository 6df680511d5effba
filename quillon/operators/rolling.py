"""Rolling features of each security over its own observations; one shuffle by security serves all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quillon.plans.config import ModelConfig
from quillon.sources.schemas import DATE, ID

def _order() -> WindowSpec:
    return Window.partitionBy(ID).orderBy(DATE)


def feed(returns: DataFrame, prices: DataFrame) -> DataFrame:
    """The observations: rows with a return and a price, with their dollar volume."""
    volume = prices.select(ID, DATE, (F.col("ADJUSTED_PRICE") * F.col("ADJUSTED_VOLUME")).alias("DOLLAR_VOLUME"))
    return returns.select(ID, DATE, "ONE_DAY_PCT").join(volume, [ID, DATE])


def momentum(cfg: ModelConfig, r: str = "ONE_DAY_PCT") -> Column:
    """Compounded growth of the older returns in the buffer less that of the recent ones."""
    growth, buffer = 1 + F.col(r), cfg.momentum + cfg.momentum_skip + cfg.momentum_slack
    older = F.product(growth).over(_order().rowsBetween(1 - buffer, -cfg.momentum_skip))
    recent = F.product(growth).over(_order().rowsBetween(1 - cfg.momentum_skip, 0))
    return F.when(F.row_number().over(_order()) >= cfg.momentum + cfg.momentum_skip, older - recent)


def volatility(cfg: ModelConfig, r: str = "ONE_DAY_PCT") -> Column:
    """Sample standard deviation of the last returns, once there are enough."""
    w = _order().rowsBetween(1 - cfg.volatility, 0)
    return F.when(F.row_number().over(_order()) >= cfg.volatility, F.stddev_samp(r).over(w))


def liquidity(cfg: ModelConfig, dv: str = "DOLLAR_VOLUME") -> Column:
    """Log of the mean of the last positive dollar volumes, on rows that have one."""
    positive = F.col(dv) > 0
    w = Window.partitionBy(ID, F.coalesce(positive, F.lit(False))).orderBy(DATE).rowsBetween(1 - cfg.liquidity, 0)
    return F.when(positive & (F.count(dv).over(w) == cfg.liquidity), F.ln(F.avg(dv).over(w)))


def rolling_features(returns: DataFrame, prices: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``SECURITY_ID, DATE, MOMENTUM, VOLATILITY, LIQUIDITY`` of every observation; liquidity carries over days without volume."""
    own = feed(returns, prices).withColumn("_l", liquidity(cfg))
    return own.select(ID, DATE, momentum(cfg).alias("MOMENTUM"), volatility(cfg).alias("VOLATILITY"), F.last("_l", ignorenulls=True).over(_order()).alias("LIQUIDITY"))


def as_of(spine: DataFrame, features: DataFrame, *columns: str) -> DataFrame:
    """``spine`` with the latest known value of each feature at or before its date."""
    marked = spine.withColumn("_spine", F.lit(True)).join(features.select(ID, DATE, *columns), [ID, DATE], "full")
    return marked.withColumns({c: F.last(c, ignorenulls=True).over(_order()) for c in columns}).filter("_spine").drop("_spine")


def ring_values(df: DataFrame, value: str, size: int) -> DataFrame:
    """``df`` with ``BUFFER``: the last ``size`` non-null values of each security, oldest first."""
    return df.withColumn("BUFFER", F.collect_list(value).over(_order().rowsBetween(1 - size, 0)))
