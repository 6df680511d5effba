"""A whole model run: exposures, factor returns, specific returns, covariance, specific risk, names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.scalars import iso
from quillon.operators import covariance, crosssection, metadata, regression, rolling
from quillon.operators.characteristics import characteristics
from quillon.plans import lineage
from quillon.plans.config import ModelConfig
from quillon.plans.lineage import cut
from quillon.sources.schemas import DATE, ID
from quillon.sources.sinks import write_outputs
from quillon.sources.warehouse import Warehouse


@dataclass
class Exposures:
    """Exposures by security and date, a column for each factor, and the factors' names."""

    wide: DataFrame
    factors: list[str]
    model: str

    def long(self) -> DataFrame:
        return crosssection.to_long(self.wide, self.factors, self.model)


def build_exposures(tables: dict[str, DataFrame], cfg: ModelConfig, start: str | None = None, end: str | None = None) -> Exposures:
    """Styles, sectors and regions; look-back rows feed the rolling features and are then left out."""
    prices, returns = tables["prices"], tables["returns"]
    rows = characteristics(tables["fundamentals"], tables["universe"], prices)
    rows = rolling.as_of(rows, rolling.rolling_features(returns, prices, cfg), *crosssection.ROLLING)
    for bound, keep in ((start, F.col(DATE) >= F.lit(start).cast("date")), (end, F.col(DATE) <= F.lit(end).cast("date"))):
        rows = rows.filter(keep) if bound else rows
    sectors, places = (crosssection.categories(tables["universe"], c) for c in ("SECTOR", "CONTINENT"))
    wide = crosssection.centred_dummies(rows, ("SECTOR", "SECTOR", sectors), ("CONTINENT", "CONTINENT", places))
    wide = crosssection.style_exposures(wide, cfg)
    factors = [*crosssection.STYLES, *(crosssection.dummy_name("SECTOR", v) for v in sectors), *(crosssection.dummy_name("CONTINENT", v) for v in places)]
    return Exposures(wide.select(ID, DATE, *factors), factors, cfg.model)


def live_factors(exposures: Exposures) -> list[str]:
    """The factors that are known somewhere: one that is null throughout would leave no complete row."""
    seen = exposures.wide.agg(*[F.count(f).alias(f) for f in exposures.factors]).first()
    return [f for f in exposures.factors if seen[f]]


def build_model(tables: dict[str, DataFrame], cfg: ModelConfig, start: str | None = None, end: str | None = None, dated_text: bool = True) -> dict[str, DataFrame]:
    """All output tables. Exposures and factor returns have several readers, so each is written once and read again."""
    made = build_exposures(tables, cfg, start, end)
    made = Exposures(cut(made.wide, "exposures"), made.factors, made.model)
    long = made.long()
    returns = tables["returns"].join(made.wide.select(DATE).distinct(), DATE, "left_semi")
    factors = cut(regression.factor_returns(made.wide, returns, live_factors(made), cfg), "factor-returns")
    out = {
        "exposures": long, "factor_returns": factors, "specific_returns": regression.specific_returns(made.wide, returns, factors, cfg),
        "specific_risk": covariance.specific_risk(made.wide, returns, factors, cfg), "factor_covariance": covariance.factor_covariance(factors, cfg), "factor_names": metadata.factor_names(long, cfg),
    }
    return {k: df.withColumn(DATE, iso(DATE)) if dated_text and DATE in df.columns else df for k, df in out.items()}


def run_model(spark: SparkSession, data: str, output: str, start: str, end: str, cfg: ModelConfig, source: str | None = None, options: dict[str, str] | None = None) -> None:
    """Fill the folder ``data`` from ``source`` if one is given, build the model of its tables, write the outputs, and delete the
    tables that were written on the way."""
    if source:
        with Warehouse(spark, source=source, options=options, config=cfg) as house:
            house.download(start, end, data)
    with Warehouse(spark, folder=data, config=cfg) as house:
        before = lineage.written()
        write_outputs(build_model(house.model_tables(start, end), cfg, start, end), output)
        lineage.clear(spark, lineage.written()[len(before) :])
