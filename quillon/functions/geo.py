"""Continent and market status of a country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Countries by continent.
CONTINENTS = {
    "North America": ("United States", "USA", "US", "Canada", "Mexico"),
    "South America": ("Brazil", "Argentina", "Chile", "Colombia", "Peru", "Venezuela"),
    "Europe": ("United Kingdom", "UK", "Germany", "France", "Italy", "Spain", "Netherlands", "Switzerland", "Sweden", "Norway", "Denmark", "Belgium", "Austria", "Ireland", "Finland", "Poland", "Portugal", "Greece", "Russia"),
    "Asia": ("China", "Japan", "India", "South Korea", "Singapore", "Hong Kong", "Taiwan", "Thailand", "Malaysia", "Indonesia", "Philippines", "Vietnam", "Australia", "New Zealand"),
    "Africa": ("South Africa", "Egypt", "Nigeria", "Kenya", "Morocco"),
    "Middle East": ("Saudi Arabia", "United Arab Emirates", "UAE", "Israel", "Turkey", "Qatar", "Kuwait"),
}
#: Countries that count as developed markets; the others are developing.
DEVELOPED = frozenset(
    ("United States", "USA", "US", "Canada", "United Kingdom", "UK", "Germany", "France", "Italy", "Spain", "Netherlands", "Switzerland", "Sweden", "Norway", "Denmark", "Belgium", "Austria", "Ireland", "Finland", "Portugal", "Greece", "Japan", "South Korea", "Singapore", "Hong Kong", "Taiwan", "Australia", "New Zealand", "Israel")
)
UNKNOWN = "Unknown"


def country_rows() -> list[tuple[str, str, str]]:
    return [(c, where, "Developed" if c in DEVELOPED else "Developing") for where, names in CONTINENTS.items() for c in names]


def countries(spark: SparkSession) -> DataFrame:
    """``country_key, continent, status``: 56 rows; keys are in lower case."""
    return spark.createDataFrame([(c.lower(), a, b) for c, a, b in country_rows()], "country_key string, continent string, status string")


def _lookup(country: Column, part: int) -> Column:
    made = F.create_map(*[F.lit(x) for row in country_rows() for x in (row[0].lower(), row[part])])
    return F.coalesce(F.try_element_at(made, F.lower(F.trim(country))), F.lit(UNKNOWN))


def continent(country: Column) -> Column:
    """A country's continent, whatever its case and outer spaces; Unknown for null, empty and others."""
    return _lookup(country, 1)


def developed_status(country: Column) -> Column:
    return _lookup(country, 2)


def continent_developed(country: Column) -> Column:
    """Continent and status; both Unknown if either is."""
    a, b = continent(country), developed_status(country)
    return F.when((a == UNKNOWN) | (b == UNKNOWN), f"{UNKNOWN} {UNKNOWN}").otherwise(F.concat_ws(" ", a, b))


def with_geography(universe: DataFrame, country: str = "COUNTRY") -> DataFrame:
    """``universe`` with CONTINENT, unless it has it; by a join with 56 rows, a size fixed in the code."""
    if "CONTINENT" in universe.columns:
        return universe
    table = F.broadcast(countries(universe.sparkSession))
    joined = universe.join(table, F.lower(F.trim(F.col(country))) == F.col("country_key"), "left")
    both = F.coalesce(F.concat_ws(" ", F.col("continent"), F.col("status")), F.lit(""))
    return joined.withColumn("_both", F.when(F.col("status").isNull(), f"{UNKNOWN} {UNKNOWN}").otherwise(both)).drop("country_key", "continent", "status").withColumnRenamed("_both", "CONTINENT")
