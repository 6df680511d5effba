"""Write a model's outputs as Parquet and CSV, dates as yyyy-MM-dd text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillon.plans.lineage import cut
from quillon.sources.schemas import DATE

#: The tables of a run and the files they become; specific variance goes to two.
FILES = {"exposures": ["exposures"], "factor_returns": ["factor_returns"], "specific_returns": ["specific_returns"], "specific_risk": ["specific_risk", "variance"], "factor_covariance": ["factor_covariance"], "factor_names": ["factor_model_factor_names"]}


def write_outputs(outputs: dict[str, DataFrame], folder: str, formats: tuple[str, ...] = ("csv", "parquet")) -> None:
    """Each table once per file name and format, split by ranges of its dates: sorted overall without one big task."""
    for name, files in FILES.items():
        if name not in outputs:
            continue
        df = cut(outputs[name], name)  # computed once, whatever the files and formats
        keys = [c for c in (DATE, "SECURITY_ID", "FACTOR_NAME", "FACTOR_NAME_1", "FACTOR_NAME_2") if c in df.columns]
        if keys:
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        for file in files:
            for kind in formats:
                writer = df.write.mode("overwrite").format(kind)
                (writer.option("header", True) if kind == "csv" else writer).save(f"{folder}/{file}.{kind}")
