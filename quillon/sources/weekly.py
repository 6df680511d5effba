"""The weekly sample: suppliers of the star-schema tables as securities, ISO weeks as dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.returns import daily_returns
from quillon.plans.lineage import cut
from quillon.sources.schemas import DATE, ID

#: Sector names by supplier number modulo their count.
SECTORS = ("Technology", "Health Care", "Financials", "Energy", "Consumer Goods", "Utilities")


def weekly_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``prices, returns, fundamentals, universe`` from ``lineitem, part, supplier, nation, region``."""
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "part", "supplier", "nation", "region")}
    week = F.to_date(F.date_trunc("week", "l_shipdate"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = t["lineitem"].join(t["part"].select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    total = lines.groupBy(F.col("l_suppkey").alias("k"), week.alias(DATE)).agg(
        F.sum("l_extendedprice").alias("ext"), F.sum("l_quantity").alias("qty"), F.sum(net).alias("s_ltm"), F.sum(net * (1 + F.col("l_tax"))).alias("s_ntm"), F.sum(F.col("l_quantity") * F.col("p_retailprice")).alias("cogs")
    )
    # Every table reads these totals, so they are written once.
    total = cut(total, "weekly").withColumn(ID, F.concat(F.lit("S"), F.col("k").cast("string")))
    prices = total.select(ID, DATE, F.try_divide("ext", "qty").alias("ADJUSTED_PRICE"), F.col("qty").alias("ADJUSTED_VOLUME"), F.lit("USD").alias("CURRENCY"), F.lit(False).alias("IS_HOLIDAY"))
    ltm, ntm = F.col("s_ltm") - F.col("cogs"), F.col("s_ntm") - F.col("cogs")
    fundamentals = total.select(ID, DATE, F.col("s_ltm").alias("SALES_LTM"), F.col("s_ntm").alias("SALES_NTM"), F.col("cogs").alias("COGS_LTM"), ltm.alias("EBITDA_LTM"), ntm.alias("EBITDA_NTM"), F.try_divide(ltm, "qty").alias("EPS_LTM"), F.try_divide(ntm, "qty").alias("EPS_NTM"))
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    status = F.when(F.col("n_nationkey") % 2 == 0, " Developed").otherwise(" Developing")
    sector = F.get(F.array(*map(F.lit, SECTORS)), (F.col("s_suppkey") % len(SECTORS)).cast("int"))
    universe = t["supplier"].join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias(ID), F.col("n_name").alias("COUNTRY"), sector.alias("SECTOR"), F.concat("r_name", status).alias("CONTINENT"))
    return {"prices": prices, "returns": daily_returns(prices), "fundamentals": fundamentals, "universe": universe}
