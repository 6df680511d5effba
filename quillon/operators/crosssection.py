"""Cross-sections: winsorise, standardise, combine, centre dummies.

Statistics are windows by date, so that one exchange serves all steps that follow each other. A date's securities meet in one
task, as they do for its regression: their number doesn't grow with history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quillon.functions.scalars import clipped, dummy_name, mean_of
from quillon.operators.characteristics import GROWTH, PROFITABILITY, VALUE
from quillon.plans.config import ModelConfig
from quillon.plans.lineage import cut
from quillon.sources.schemas import DATE, ID

ROLLING = ("MOMENTUM", "VOLATILITY", "LIQUIDITY")
CHARACTERISTICS = (*VALUE, *PROFITABILITY, *GROWTH, *ROLLING)
COMPOSITES = {"VALUE": VALUE, "PROFITABILITY": PROFITABILITY, "GROWTH": GROWTH}
STYLES = (*COMPOSITES, *ROLLING)


def _of_date() -> WindowSpec:
    return Window.partitionBy(DATE)


def winsorize(df: DataFrame, columns: tuple[str, ...], bounds: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """Each column within its own interpolated quantiles of the date."""
    limits = {f"_q_{c}": F.percentile(c, F.array(*map(F.lit, bounds))).over(_of_date()) for c in columns}
    return df.withColumns(limits).withColumns({c: clipped(F.col(c), F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]) for c in columns}).drop(*limits)


def zscore(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Each column less its mean over its sample deviation of the date; unscaled where that is null or zero."""
    stats = {f"_{k}_{c}": f(c).over(_of_date()) for c in columns for k, f in (("m", F.avg), ("s", F.stddev_samp))}
    scaled = lambda c: F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}"))).otherwise(F.col(c))
    return df.withColumns(stats).withColumns({c: scaled(c) for c in columns}).drop(*stats)


def composites(df: DataFrame) -> DataFrame:
    """Means of standardised members, standardised again."""
    return zscore(df.withColumns({name: mean_of(*members) for name, members in COMPOSITES.items()}), tuple(COMPOSITES))


def style_exposures(df: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``df`` with the six styles, from its twelve characteristics."""
    return composites(zscore(winsorize(df, CHARACTERISTICS, cfg.winsor), CHARACTERISTICS))


def categories(universe: DataFrame, column: str) -> list[str]:
    """The values of a category column: as many as there are sectors or regions."""
    return sorted(r[0] for r in universe.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def centred_dummies(df: DataFrame, *categories: tuple[str, str, list[str]]) -> DataFrame:
    """``df`` with a column for each value of each (column, prefix, values): 1 or 0, less the date's share of it.

    Null has 0 everywhere.
    """
    flags = {dummy_name(prefix, v): F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)) for column, prefix, values in categories for v in values}
    return df.withColumns({n: flag - F.avg(flag).over(_of_date()) for n, flag in flags.items()})


def to_long(wide: DataFrame, factors: list[str], model: str) -> DataFrame:
    """``MODEL, DATE, SECURITY_ID, FACTOR_NAME, EXPOSURE`` of the non-null exposures."""
    long = wide.unpivot([ID, DATE], factors, "FACTOR_NAME", "EXPOSURE").filter(F.col("EXPOSURE").isNotNull())
    return long.select(F.lit(model).alias("MODEL"), DATE, ID, "FACTOR_NAME", "EXPOSURE")


def to_wide(long: DataFrame, factors: list[str]) -> DataFrame:
    """A column for each factor; of repeated rows, one value."""
    return long.groupBy(ID, DATE).pivot("FACTOR_NAME", factors).agg(F.first("EXPOSURE"))


def wide_of(exposures: DataFrame) -> tuple[DataFrame, list[str]]:
    """Exposures with a column for each factor, and the factors; long ones are pivoted, and written, as their plan is deep."""
    if "FACTOR_NAME" in exposures.columns:
        names = sorted(r[0] for r in exposures.select("FACTOR_NAME").distinct().collect())
        return cut(to_wide(exposures, names), "wide"), names
    return exposures, [c for c in exposures.columns if c not in (ID, DATE)]
