"""Names and groups of a model's factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.crosssection import STYLES
from quillon.operators.regression import INTERCEPT
from quillon.plans.config import ModelConfig


def factor_names(exposures: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``MODEL, FACTOR_DISPLAY_NAME, FACTOR_GROUP``: styles, sectors, regions, the intercept; each group in order."""
    name = F.col("FACTOR_NAME")
    spaced = lambda prefix: F.replace(F.substr(name, F.lit(len(prefix) + 1)), F.lit("_"), F.lit(" "))
    sector, place = name.startswith("SECTOR_"), name.startswith("CONTINENT_")
    style = F.array_position(F.array(*map(F.lit, STYLES)), name)
    shown = F.when(sector, F.concat(spaced("SECTOR_"), F.lit(" Sector"))).when(place, spaced("CONTINENT_")).when(name == INTERCEPT, "Intercept").otherwise(name)
    group = F.when(sector, "Sector Factors").when(place, "Geographic Factors").when(name == INTERCEPT, "Market Factor").when(style > 0, "Style Factors")
    rank = F.when(style > 0, style).when(sector, 100).when(place, 200).otherwise(300)
    found = exposures.select("FACTOR_NAME").distinct()
    out = found.select(F.lit(cfg.model).alias("MODEL"), shown.alias("FACTOR_DISPLAY_NAME"), group.alias("FACTOR_GROUP"), rank.alias("_rank"), name)
    return out.filter(F.col("FACTOR_GROUP").isNotNull()).orderBy("_rank", "FACTOR_NAME").select("MODEL", "FACTOR_DISPLAY_NAME", "FACTOR_GROUP")


def diagnostics(exposures: DataFrame) -> DataFrame:
    """One row: dates, securities and factors seen, first and last date, rows."""
    return exposures.agg(F.count_distinct("DATE").alias("n_dates"), F.count_distinct("SECURITY_ID").alias("n_securities"), F.count_distinct("FACTOR_NAME").alias("n_factors"), F.min("DATE").alias("first_date"), F.max("DATE").alias("last_date"), F.count(F.lit(1)).alias("n_rows"))
