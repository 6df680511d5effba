"""Readers of the source tables. Everything is lazy; filters and columns reach the scan."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quillon.functions.geo import with_geography
from quillon.operators.returns import daily_returns
from quillon.plans.config import ModelConfig
from quillon.sources.schemas import DATE, ID, INPUTS, canonical

Day = str | datetime.date


class Warehouse:
    """Tables by name, from a folder of Parquet files, a catalog, a connector's options, or given DataFrames.

    ``options`` go to ``spark.read.format(source)`` with the table's name as ``dbtable``, for JDBC-like sources.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, tables: dict[str, DataFrame] | None = None, source: str | None = None, options: dict[str, str] | None = None, config: ModelConfig | None = None):
        self.spark, self.folder, self.tables, self.source, self.options = spark, folder, dict(tables or {}), source, dict(options or {})
        self.config = config or ModelConfig()
        self.open = False

    def connect(self) -> Warehouse:
        if self.folder is None and not self.tables and not self.source:
            raise ConnectionError("no folder, tables or source given")
        self.open = True
        return self

    def disconnect(self) -> None:
        self.open = False

    __enter__ = connect

    def __exit__(self, *_) -> None:
        self.disconnect()

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        if self.source:
            return self.spark.read.format(self.source).options(**self.options, dbtable=name).load()
        if self.folder is None:
            return self.spark.table(name)
        try:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        except AnalysisException:
            if name != "universe":
                raise
            return self.spark.read.csv(f"{self.folder}/{name}.csv", header=True, schema=INPUTS["universe"])

    def query(self, text: str, **values) -> DataFrame:
        """The result of an SQL text; values are bound, never pasted in."""
        try:
            return self.spark.sql(text, args=values or None)
        except AnalysisException as e:
            raise RuntimeError(f"the query failed: {text[:200]}") from e

    def _dated(self, name: str, start: Day | None, end: Day | None) -> DataFrame:
        df = canonical(self.table(name))
        least = self.config.min_date
        df = df.filter(F.col(DATE) >= F.greatest(F.lit(str(start or least)).cast("date"), F.lit(least).cast("date")))
        return df.filter(F.col(DATE) <= F.lit(str(end)).cast("date")) if end else df

    @staticmethod
    def _of(df: DataFrame, ids: DataFrame | Iterable[str] | None, spark: SparkSession) -> DataFrame:
        """Rows of the given securities: a semi join, so any number of them will do."""
        if ids is None:
            return df
        if not isinstance(ids, DataFrame):
            ids = spark.createDataFrame([(x,) for x in ids], f"{ID} string")
        return df.join(canonical(ids, dated=False).select(ID).distinct(), ID, "left_semi")

    def prices_by_date_range(self, start: Day, end: Day) -> DataFrame:
        """Prices of all securities on trading days."""
        return self._dated("prices", start, end).filter(~F.col("IS_HOLIDAY"))

    def prices(self, start: Day | None = None, end: Day | None = None, ids=None) -> DataFrame:
        return self._of(self._dated("prices", start, end), ids, self.spark)

    def fundamentals(self, start: Day | None = None, end: Day | None = None, ids=None) -> DataFrame:
        return self._of(self._dated("fundamentals", start, end), ids, self.spark)

    fundamentals_by_date_range = fundamentals

    def universe(self, ids=None) -> DataFrame:
        """One row per security; of repeated ids, the smallest country and sector."""
        df = canonical(self.table("universe"), dated=False)
        for c in ("COUNTRY", "SECTOR"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        df = df.groupBy(ID).agg(F.min(F.struct("COUNTRY", "SECTOR", *[c for c in df.columns if c not in (ID, "COUNTRY", "SECTOR")])).alias("_")).select(ID, "_.*")
        return self._of(df, ids, self.spark)

    def exchange_rates(self, start: Day | None = None, end: Day | None = None) -> DataFrame:
        """Dollars per unit by day and currency; an empty table if there is none."""
        try:
            df = self.table("exchange_rates")
        except AnalysisException:
            return self.spark.createDataFrame([], INPUTS["exchange_rates"])
        for old, new in (("CURRENCYCODE", "CURRENCY"), ("EXCHANGERATE", "EXCHANGE_RATE_TO_USD")):
            df = df.withColumnRenamed(old, new)
        df = df.withColumn(DATE, F.to_date(DATE)).filter(F.col(DATE) >= F.lit(str(start or self.config.min_date)).cast("date"))
        return df.filter(F.col(DATE) <= F.lit(str(end)).cast("date")) if end else df

    def market_value(self, start: Day | None = None, end: Day | None = None, ids=None) -> DataFrame:
        return self._of(self._dated("market_value", start, end), ids, self.spark)

    def enterprise_value(self, start: Day | None = None, end: Day | None = None, ids=None) -> DataFrame:
        return self._of(self._dated("enterprise_value", start, end), ids, self.spark)

    def stock_data(self, tickers: Iterable[str], start: Day, end: Day, prices: str = "ohlcv", fundamentals: str = "legacy_fundamentals") -> tuple[DataFrame, DataFrame]:
        """Rows of the older ticker-keyed tables."""
        wanted = F.col("ticker").isin(list(tickers)) & F.col("date").between(str(start), str(end))
        return self.table(prices).filter(wanted), self.table(fundamentals).filter(wanted)

    def index_returns(self, start: Day, end: Day, table: str = "index_prices") -> DataFrame:
        """Daily returns of an index from its table of closing prices."""
        df = self._dated(table, start, end)
        return daily_returns(df).select(DATE, "ONE_DAY_PCT")

    def trading_dates(self, start: Day, end: Day) -> DataFrame:
        """Distinct trading days as text, in order."""
        days = self.prices_by_date_range(start, end).select(DATE).distinct()
        return days.orderBy(DATE).select(F.date_format(DATE, "yyyy-MM-dd").alias(DATE))

    def is_holiday(self, day: Day) -> DataFrame:
        """A row: true without prices on the day, or if all are marked as holiday."""
        of_day = canonical(self.table("prices")).filter(F.col(DATE) == F.lit(str(day)).cast("date"))
        return of_day.agg(F.coalesce(F.bool_and("IS_HOLIDAY"), F.lit(True)).alias("IS_HOLIDAY"))

    def data_for_date(self, day: Day) -> dict[str, DataFrame]:
        """All tables on one day; empty ones on a holiday."""
        open_ = ~F.col("_closed")
        closed = F.broadcast(self.is_holiday(day).withColumnRenamed("IS_HOLIDAY", "_closed"))  # one row
        only = lambda df: df.join(closed, F.lit(True)).filter(open_).drop("_closed")
        prices = only(self.prices_by_date_range(day, day))
        return {
            "prices": prices, "fundamentals": only(self.fundamentals(day, day)), "universe": self.universe(prices), "exchange_rates": only(self.exchange_rates(day, day)),
            "market_value": only(self.market_value(day, day)), "enterprise_value": only(self.enterprise_value(day, day)),
        }

    def returns(self, start: Day | None = None, end: Day | None = None) -> DataFrame:
        """The returns table if there is one, else returns of the prices."""
        try:
            return self._dated("returns", start, end).filter(F.col("ONE_DAY_PCT").isNotNull())
        except (AnalysisException, KeyError):
            return daily_returns(self.prices(start, end))

    def model_tables(self, start: Day, end: Day) -> dict[str, DataFrame]:
        """What a model run reads: prices and returns with their lookback, fundamentals, and the universe with geography."""
        universe = with_geography(self.universe())
        if not universe.take(1):
            raise ValueError("the universe is empty")
        before = str(datetime.date.fromisoformat(str(start)) - datetime.timedelta(days=self.config.lookback_days))
        return {"prices": self.prices_by_date_range(before, end), "returns": self.returns(before, end), "fundamentals": self.fundamentals(start, end), "universe": universe}

    def sample_ids(self, n: int | None = None) -> DataFrame:
        """Up to ``n`` securities of the universe, the same on every run."""
        n = n or self.config.max_stocks
        ids = self.universe().select(ID)
        return ids if n is None else ids.orderBy(F.xxhash64(ID, F.lit(self.config.sample_seed)), ID).limit(n)

    def all_data(self, start: Day, end: Day) -> dict[str, DataFrame]:
        """The seven tables; if the universe has more securities than ``config.max_stocks`` (500 by default, None for all), those of
        a seeded sample of that many."""
        ids = self.sample_ids()
        return {
            "universe": self.universe(ids), "prices": self.prices(start, end, ids), "fundamentals": self.fundamentals(start, end, ids), "returns": daily_returns(self.prices(start, end, ids)),
            "exchange_rates": self.exchange_rates(start, end), "market_value": self.market_value(start, end, ids), "enterprise_value": self.enterprise_value(start, end, ids),
        }

    def download(self, start: Day, end: Day, folder: str) -> None:
        """Write what a run reads to a folder of Parquet tables, by year where they are dated."""
        for name, df in self.model_tables(start, end).items():
            if DATE in df.columns:
                df.withColumn("year", F.year(DATE)).write.mode("overwrite").partitionBy("year").parquet(f"{folder}/{name}.parquet")
            else:
                df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
                df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
