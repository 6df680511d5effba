"""Run a factor model from the command line: ``python -m quillon --start 2020-01-01 --data data --output results``."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from quillon.plans.config import ModelConfig
from quillon.plans.model import run_model


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quillon", description="Exposures, factor returns, specific returns, risk, covariance and names as Parquet and CSV.")
    p.add_argument("--start", default="2020-01-01")
    p.add_argument("--end", default=str(datetime.date.today() - datetime.timedelta(days=1)), help="default: yesterday")
    p.add_argument("--data", default="data", help="folder of the downloaded tables")
    p.add_argument("--output", default="results")
    p.add_argument("--download", metavar="FORMAT", help="fill the data folder first, through this Spark source; without it the folder is taken as it is")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="an option of that source; may be repeated")
    p.add_argument("--neutralize", action="store_true")
    o = p.parse_args(args)
    spark = SparkSession.builder.appName("quillon").getOrCreate()
    options = dict(x.split("=", 1) for x in o.option)
    run_model(spark, o.data, o.output, o.start, o.end, ModelConfig(neutralize=o.neutralize), o.download, options)


if __name__ == "__main__":
    main()
