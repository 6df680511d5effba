"""Cross-sectional factor returns and what they leave over."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.crosssection import wide_of
from quillon.plans.config import ModelConfig
from quillon.plans.lineage import cut, sized_join
from quillon.sources.schemas import DATE, ID

INTERCEPT = "INTERCEPT"


def factor_returns(wide: DataFrame, returns: DataFrame, factors: list[str], cfg: ModelConfig) -> DataFrame:
    """``MODEL, DATE, FACTOR_NAME, RETURN``: least squares of returns on exposures, date by date.

    Rows count if all factors and the return are known; a date needs as many rows as coefficients and one more. Dummies are
    linearly dependent by construction, so the solution is that of least norm, by singular values of the sorted rows. One
    date's rows go to one task: securities times factors, which doesn't grow with the number of dates.
    """
    exposures = wide.select(ID, DATE, *[F.col(f).try_cast("double").alias(f) for f in factors]).dropna(subset=factors)
    rows = exposures.join(returns.select(ID, DATE, F.col("ONE_DAY_PCT").try_cast("double").alias("_y")), [ID, DATE]).filter(F.col("_y").isNotNull())
    names = [INTERCEPT, *factors] if cfg.intercept else factors

    def nothing() -> pd.DataFrame:
        return pd.DataFrame({DATE: [], "FACTOR_NAME": [], "RETURN": []}, dtype=object)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) < len(names) + 1:
            return nothing()
        group = group.sort_values(ID, kind="stable")
        x = group[factors].to_numpy(float)
        if cfg.intercept:
            x = np.column_stack([np.ones(len(x)), x])
        try:
            beta = np.linalg.lstsq(x, group["_y"].to_numpy(float), rcond=cfg.cutoff)[0]
        except np.linalg.LinAlgError:
            return nothing()
        return pd.DataFrame({DATE: group[DATE].iloc[0], "FACTOR_NAME": names, "RETURN": beta})

    out = rows.groupBy(DATE).applyInPandas(solve, f"{DATE} date, FACTOR_NAME string, RETURN double")
    return out.select(F.lit(cfg.model).alias("MODEL"), DATE, "FACTOR_NAME", "RETURN")


def returns_by_date(factors: DataFrame, names: list[str]) -> DataFrame:
    """A row for each date with factor returns: one column ``_r_k`` for the k-th of ``names``."""
    return factors.groupBy(DATE).agg(*[F.max(F.when(F.col("FACTOR_NAME") == n, F.col("RETURN"))).alias(f"_r_{k}") for k, n in enumerate(names)])


def specific_returns(exposures: DataFrame, returns: DataFrame, factors: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``MODEL, DATE, SECURITY_ID, SPECIFIC_RETURN``: the return less the sum of exposure times factor return.

    Exposures are wide or long. Unknown ones and factors without a return count as zero; securities without a known exposure and
    dates without factor returns are left out. A date's factor returns are one row, which meets its securities: a row per
    security and date is joined with returns and is otherwise one projection.
    """
    wide, names = wide_of(exposures)
    rows = wide.filter(F.coalesce(*names).isNotNull() if names else F.lit(False)).join(returns.select(ID, DATE, "ONE_DAY_PCT"), [ID, DATE]).filter(F.col("ONE_DAY_PCT").isNotNull())
    every = [*names, INTERCEPT]
    days = cut(returns_by_date(factors, every), "factor-days")
    left = F.col("ONE_DAY_PCT")
    for k, n in enumerate(every):
        if n != INTERCEPT:
            left = left - F.coalesce(F.col(n) * F.col(f"_r_{k}"), F.lit(0.0))
        elif cfg.subtract_intercept:
            left = left - F.coalesce(F.col(f"_r_{k}"), F.lit(0.0))
    out = sized_join(rows, days, DATE, "inner", *[f"_r_{k}" for k in range(len(every))])
    return out.select(F.lit(cfg.model).alias("MODEL"), DATE, ID, left.alias("SPECIFIC_RETURN"))
