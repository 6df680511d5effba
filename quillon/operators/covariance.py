"""Rolling factor covariance and specific variance over the last factor-return dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.crosssection import wide_of
from quillon.operators.regression import INTERCEPT
from quillon.plans.config import ModelConfig
from quillon.plans.lineage import cut, sized_join
from quillon.sources.schemas import DATE, ID


def _indexed(factors: DataFrame) -> DataFrame:
    """Dates of factor returns with their number, from 0. A row per date: the one window without a key sees no more."""
    days = factors.select(DATE).distinct()
    return days.withColumn("idx", F.row_number().over(Window.orderBy(DATE)) - 1)


def _pairs(factors: DataFrame) -> DataFrame:
    """``DATE, idx, f, g, x, y`` of factor pairs f <= g."""
    values = factors.groupBy(DATE, "FACTOR_NAME").agg(F.avg("RETURN").alias("r"))
    a = values.join(_indexed(factors), DATE).select(DATE, "idx", F.col("FACTOR_NAME").alias("f"), F.col("r").alias("x"))
    b = values.select(DATE, F.col("FACTOR_NAME").alias("g"), F.col("r").alias("y"))
    return a.join(b, DATE).filter(F.col("f") <= F.col("g"))


def rolling_covariance(factors: DataFrame, window: int) -> DataFrame:
    """``DATE, idx, f, g, cov``: sample covariance of each pair over the ``window`` dates up to each date."""
    w = Window.partitionBy("f", "g").orderBy("idx").rangeBetween(1 - window, 0)
    return _pairs(factors).select(DATE, "idx", "f", "g", F.covar_samp("x", "y").over(w).alias("cov"))


def factor_covariance(factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``MODEL, DATE, FACTOR_NAME_1, FACTOR_NAME_2, COVARIANCE``: the upper triangle, intercept included, from the first
    date that has enough before it."""
    cov = rolling_covariance(factors, cfg.covariance).filter((F.col("idx") >= cfg.covariance_least - 1) & F.col("cov").isNotNull())
    return cov.select(F.lit(cfg.model).alias("MODEL"), DATE, F.col("f").alias("FACTOR_NAME_1"), F.col("g").alias("FACTOR_NAME_2"), F.col("cov").alias("COVARIANCE"))


def _with_exposure(exposures: DataFrame, factors: DataFrame) -> tuple[DataFrame, list[str]]:
    """Wide exposures of securities that know one of a factor that has returns, and those factors, without the intercept."""
    wide, names = wide_of(exposures)
    seen = {r[0] for r in factors.select("FACTOR_NAME").distinct().collect()}
    names = [n for n in names if n in seen and n != INTERCEPT]
    return wide.filter(F.coalesce(*names).isNotNull() if names else F.lit(False)).select(ID, DATE, *names), names


def _variances(keys: DataFrame, returns: DataFrame, factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """The rows of ``keys`` that have a ``TOTAL_VAR``, with it."""
    days = _indexed(factors)
    panel = keys.withColumn("_own", F.lit(True)).join(returns.select(ID, DATE, "ONE_DAY_PCT"), [ID, DATE], "full")
    # Days between two factor-return dates get the place after the earlier one, over the distinct days only.
    every = keys.select(DATE).unionByName(returns.select(DATE)).distinct().join(days, DATE, "left").withColumn("_last", F.last("idx", ignorenulls=True).over(Window.orderBy(DATE)))
    placed = panel.join(every.filter(F.col("_last").isNotNull()), DATE).withColumn("pos", F.when(F.col("idx").isNotNull(), 2 * F.col("idx")).otherwise(2 * F.col("_last") + 1))
    w = Window.partitionBy(ID).orderBy("pos").rangeBetween(-2 * (cfg.risk - 1), 0)
    out = placed.withColumns({"_n": F.count("ONE_DAY_PCT").over(w), "TOTAL_VAR": F.var_samp("ONE_DAY_PCT").over(w)})
    enough = (F.col("idx") >= cfg.risk - 1) & (F.col("_n") >= cfg.risk // 2) & (F.col("TOTAL_VAR") > 0)
    return out.filter(F.col("_own") & enough).select(*keys.columns, "TOTAL_VAR")


def total_variance(exposures: DataFrame, returns: DataFrame, factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``DATE, SECURITY_ID, TOTAL_VAR`` on exposure rows: sample variance of a security's returns since the window's first
    factor-return date. Returns between two such dates count too: dates get even places, what lies between odd ones."""
    wide, _ = _with_exposure(exposures, factors)
    return _variances(wide.select(ID, DATE).distinct(), returns, factors, cfg).select(DATE, ID, "TOTAL_VAR")


def factor_variance(exposures: DataFrame, factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``DATE, SECURITY_ID, FACTOR_VAR``: the quadratic form of the known exposures with the window's covariance, without
    the intercept; null if the covariance of two of them is.

    Exposures stay wide: a date's matrix, one row, meets its securities, and the form is one projection.
    """
    wide, names = _with_exposure(exposures, factors)
    plain = factors.filter(F.col("FACTOR_NAME").isin(names))
    cov = rolling_covariance(plain, cfg.risk).filter((F.col("idx") >= cfg.risk - 1) & F.col("cov").isNotNull())
    both = cov.unionByName(cov.filter("f <> g").select(DATE, "idx", F.col("g").alias("f"), F.col("f").alias("g"), "cov"))
    rows = both.groupBy(DATE, "f").agg(F.map_from_entries(F.collect_list(F.struct("g", "cov"))).alias("row"))
    table = rows.groupBy(DATE).agg(F.map_from_entries(F.collect_list(F.struct("f", "row"))).alias("cov"))
    order = F.array(*map(F.lit, names)).cast("array<string>")
    matrix = F.transform(order, lambda f: F.transform(order, lambda g: F.try_element_at(F.try_element_at("cov", f), g)))
    dated = _indexed(plain).filter(F.col("idx") >= cfg.risk - 1).select(DATE).join(table, DATE, "left").select(DATE, matrix.alias("_m"))
    dated = cut(dated, "covariances")
    own = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("b")) for k, n in enumerate(names)]), lambda x: x["b"].isNotNull())

    def product(x: Column) -> Column:
        row = F.get("_m", x["k"])
        return x["b"] * F.aggregate("_b", F.lit(0.0), lambda a, c: a + c["b"] * F.get(row, c["k"]))

    form = F.aggregate(F.transform("_b", product), F.lit(0.0), lambda a, x: a + x)
    if not names:
        return wide.select(DATE, ID, F.lit(None).cast("double").alias("FACTOR_VAR"))
    return sized_join(wide.select(ID, DATE, own.alias("_b")), dated, DATE, "inner", "_m").select(DATE, ID, form.alias("FACTOR_VAR"))


def specific_variance(total: Column, factor: Column, cfg: ModelConfig) -> Column:
    """Total less factor variance, the latter at most a share of the former, and the rest at least a share of it."""
    explained = F.greatest(F.coalesce(factor, F.lit(0.0)), F.lit(0.0))
    capped = F.when(explained >= total, cfg.risk_cap * total).otherwise(explained)
    return F.greatest(total - capped, cfg.risk_floor * total, F.lit(cfg.risk_epsilon))


def specific_risk(exposures: DataFrame, returns: DataFrame, factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``MODEL, DATE, SECURITY_ID, SPECIFIC_VAR`` of dates with a whole window and securities with half of one and a known
    exposure. Factor variance rides along to the window of returns, so that nothing is joined afterwards; where a covariance is
    unknown it counts as zero."""
    explained = factor_variance(exposures, factors, cfg)
    both = _variances(explained, returns, factors, cfg)
    return both.select(F.lit(cfg.model).alias("MODEL"), DATE, ID, specific_variance(F.col("TOTAL_VAR"), F.col("FACTOR_VAR"), cfg).alias("SPECIFIC_VAR"))
