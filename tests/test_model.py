"""The factor model's operators on small frames made by hand."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import calendar, fx, geo
from quillon.operators import characteristics as ch
from quillon.operators import covariance, crosssection, metadata, regression, returns, rolling
from quillon.plans.config import ModelConfig
from quillon.sources.schemas import canonical
from quillon.sources.warehouse import Warehouse
from quillon.streaming.rolling import rolling_stream, step

DAY = datetime.date(2020, 1, 1)
SMALL = ModelConfig(momentum=6, momentum_skip=2, momentum_slack=1, volatility=4, liquidity=3, covariance=5, covariance_least=3, risk=4)


def day(k):
    return DAY + datetime.timedelta(days=k)


def test_daily_returns_skip_first_zero_and_missing(spark):
    rows = [("A", day(0), 10.0), ("A", day(1), None), ("A", day(2), 11.0), ("A", day(3), 0.0), ("A", day(4), 5.0)]
    prices = spark.createDataFrame(rows, "SECURITY_ID string, DATE date, ADJUSTED_PRICE double")
    assert [(r.DATE, r.ONE_DAY_PCT) for r in returns.daily_returns(prices).orderBy("DATE").collect()] == [(day(3), -1.0)]
    padded = [round(r.ONE_DAY_PCT, 9) for r in returns.daily_returns(prices, pad=True).orderBy("DATE").collect()]
    assert padded == [0.0, 0.1, -1.0]


def observations(n, seed=3, zero_every=4):
    rng = np.random.default_rng(seed)
    r, dv = rng.normal(0, 0.02, n), rng.uniform(1, 9, n)
    dv[::zero_every] = 0
    return [("A", day(k), float(r[k]), float(dv[k])) for k in range(n)]


def ring(rows, cfg):
    state, out = ([], [], 0, None), []
    for _, d, r, dv in rows:
        *state, m, v = step(*state, r, dv, cfg)
        out.append((d, m, v, state[3]))
    return out


def test_rolling_equals_ring_buffers(spark):
    rows = observations(30)
    df = spark.createDataFrame([(a, d, r, 1.0, dv) for a, d, r, dv in rows], "SECURITY_ID string, DATE date, ONE_DAY_PCT double, ADJUSTED_PRICE double, ADJUSTED_VOLUME double")
    got = rolling.rolling_features(df, df, SMALL).orderBy("DATE").collect()
    want = ring(rows, SMALL)
    assert sum(w[1] is not None for w in want) == 30 - 8 + 1 and sum(w[2] is not None for w in want) == 27
    for g, (d, *values) in zip(got, want, strict=True):
        assert g.DATE == d
        for a, b in zip((g.MOMENTUM, g.VOLATILITY, g.LIQUIDITY), values, strict=True):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, abs_tol=1e-12))


def test_stream_equals_batch(spark, tmp_path):
    rows = observations(24)
    schema = "SECURITY_ID string, DATE date, ONE_DAY_PCT double, DOLLAR_VOLUME double"
    for k in range(3):
        spark.createDataFrame(rows[8 * k : 8 * k + 8], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    running = rolling_stream(stream, SMALL).writeStream.format("memory").queryName("rolled").outputMode("append").start()
    running.processAllAvailable()
    running.stop()
    got = {r.DATE: (r.MOMENTUM, r.VOLATILITY, r.LIQUIDITY) for r in spark.table("rolled").collect()}
    for d, *values in ring(rows, SMALL):
        for a, b in zip(got[d], values, strict=True):
            assert (a is None or math.isnan(a)) == (b is None) and (b is None or math.isclose(a, b))


def test_as_of_carries_the_last_value(spark):
    spine = spark.createDataFrame([("A", day(k), k) for k in (0, 2, 3)], "SECURITY_ID string, DATE date, k int")
    known = spark.createDataFrame([("A", day(1), 5.0), ("A", day(3), None)], "SECURITY_ID string, DATE date, MOMENTUM double")
    assert [r.MOMENTUM for r in rolling.as_of(spine, known, "MOMENTUM").orderBy("DATE").collect()] == [None, 5.0, 5.0]


def test_characteristic_masks(spark):
    columns = "k int, ADJUSTED_PRICE double, SALES_LTM double, SALES_NTM double, COGS_LTM double, EBITDA_LTM double, EBITDA_NTM double, EPS_LTM double, EPS_NTM double"
    rows = [(0, 10.0, 4.0, 5.0, 1.0, 2.0, 3.0, 1.0, 2.0), (1, 10.0, -4.0, -5.0, 1.0, 2.0, -3.0, -1.0, -2.0), (2, 0.0, 4.0, 5.0, -1.0, 2.0, 3.0, 1.0, 2.0), (3, 10.0, None, None, None, None, None, None, None)]
    made = {**ch.value_yields(), **ch.margins(), **ch.growth_rates()}
    got = spark.createDataFrame(rows, columns).select("k", *[c.alias(n) for n, c in made.items()]).orderBy("k").collect()
    assert got[0][1:] == (0.2, 0.5, 0.3, 0.1, 0.4, 0.5, 0.75, 1.0, 0.25)
    assert got[1].EY_NTM is None and got[1].SY_NTM == -0.5 and got[1].EBITDA_MARGIN is None and got[1].EPS_GROWTH is None
    assert got[2].EY_NTM is None and got[2].GROSS_MARGIN is None and got[2].EBITDA_MARGIN == 0.5
    assert all(x is None for x in got[3][1:])


def frame(spark, values, column="X"):
    return spark.createDataFrame([(str(k), d, v) for k, (d, v) in enumerate(values)], f"SECURITY_ID string, DATE date, {column} double")


def test_winsorize_interpolates(spark):
    got = crosssection.winsorize(frame(spark, [(DAY, 1.0), (DAY, 2.0), (DAY, 3.0), (DAY, 10.0), (DAY, None)]), ("X",))
    assert sorted((r.X is None, round(r.X or 0, 2)) for r in got.collect()) == [(False, 1.03), (False, 2.0), (False, 3.0), (False, 9.79), (True, 0)]


def test_zscore_leaves_single_and_constant_rows(spark):
    got = crosssection.zscore(frame(spark, [(day(0), 7.0), (day(1), 4.0), (day(1), 4.0), (day(2), 1.0), (day(2), 3.0)]), ("X",)).orderBy("DATE", "X").collect()
    assert [round(r.X, 6) for r in got] == [7.0, 4.0, 4.0, -0.707107, 0.707107]


def test_centred_dummies(spark):
    df = spark.createDataFrame([("A", day(0), "Tech"), ("B", day(0), "Oil Gas"), ("C", day(0), None), ("D", day(1), "Tech")], "SECURITY_ID string, DATE date, SECTOR string")
    got = crosssection.centred_dummies(df, ("SECTOR", "SECTOR", ["Oil Gas", "Tech"])).orderBy("SECURITY_ID").collect()
    assert [round(r.SECTOR_Tech, 6) for r in got] == [0.666667, -0.333333, -0.333333, 0.0]
    assert [round(r.SECTOR_Oil_Gas, 6) for r in got] == [-0.333333, 0.666667, -0.333333, 0.0]


def test_long_and_wide_again(spark):
    wide = spark.createDataFrame([("A", DAY, 1.0, None), ("B", DAY, 2.0, 3.0)], "SECURITY_ID string, DATE date, VALUE double, GROWTH double")
    long = crosssection.to_long(wide, ["VALUE", "GROWTH"], "M")
    assert long.count() == 3
    assert sorted(map(tuple, crosssection.to_wide(long, ["VALUE", "GROWTH"]).collect())) == sorted(map(tuple, wide.collect()))


@pytest.mark.parametrize("n, solved", [(3, False), (4, True)])
def test_regression_needs_one_row_more_than_coefficients(spark, n, solved):
    x = np.arange(n) * 1.0
    wide = spark.createDataFrame([(str(k), DAY, float(x[k]), float(x[k] ** 2)) for k in range(n)], "SECURITY_ID string, DATE date, VALUE double, GROWTH double")
    r = spark.createDataFrame([(str(k), DAY, float(1 + 2 * x[k] + 3 * x[k] ** 2)) for k in range(n)], "SECURITY_ID string, DATE date, ONE_DAY_PCT double")
    got = {x.FACTOR_NAME: x.RETURN for x in regression.factor_returns(wide, r, ["VALUE", "GROWTH"], ModelConfig()).collect()}
    assert ({k: round(v, 6) for k, v in got.items()} == {"INTERCEPT": 1.0, "VALUE": 2.0, "GROWTH": 3.0}) if solved else not got


def test_specific_returns_skip_unknown(spark):
    long = spark.createDataFrame([("M", DAY, "A", "VALUE", 2.0), ("M", DAY, "A", "GROWTH", 5.0), ("M", DAY, "B", "VALUE", 1.0), ("M", day(1), "A", "VALUE", 1.0)], "MODEL string, DATE date, SECURITY_ID string, FACTOR_NAME string, EXPOSURE double")
    r = spark.createDataFrame([("A", DAY, 0.5), ("B", DAY, None), ("A", day(1), 0.1)], "SECURITY_ID string, DATE date, ONE_DAY_PCT double")
    f = spark.createDataFrame([("M", DAY, "VALUE", 0.1), ("M", DAY, "INTERCEPT", 0.05)], "MODEL string, DATE date, FACTOR_NAME string, RETURN double")
    assert [(x.SECURITY_ID, round(x.SPECIFIC_RETURN, 9)) for x in regression.specific_returns(long, r, f, ModelConfig()).collect()] == [("A", 0.3)]
    assert [round(x.SPECIFIC_RETURN, 9) for x in regression.specific_returns(long, r, f, ModelConfig(subtract_intercept=True)).collect()] == [0.25]


def test_covariance_starts_with_enough_dates(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(8, 2))
    f = spark.createDataFrame([("M", day(k), n, float(values[k, j])) for k in range(8) for j, n in enumerate(("A", "B"))], "MODEL string, DATE date, FACTOR_NAME string, RETURN double")
    got = {(r.DATE, r.FACTOR_NAME_1, r.FACTOR_NAME_2): r.COVARIANCE for r in covariance.factor_covariance(f, SMALL).collect()}
    assert len(got) == 3 * 6
    for k in range(2, 8):
        want = np.cov(values[max(0, k - 4) : k + 1].T)
        assert np.allclose([got[day(k), "A", "A"], got[day(k), "A", "B"], got[day(k), "B", "B"]], [want[0, 0], want[0, 1], want[1, 1]])


def test_specific_risk_against_numpy(spark):
    rng = np.random.default_rng(2)
    days, names = [0, 2, 3, 5, 6, 7], ("A", "B")  # factor returns are missing on days 1 and 4
    fr = rng.normal(0, 0.01, (6, 2))
    r, beta = rng.normal(0, 0.02, (8, 3)), rng.normal(size=(8, 3, 2))
    factors = spark.createDataFrame([("M", day(d), n, float(fr[k, j])) for k, d in enumerate(days) for j, n in enumerate(names)] + [("M", day(d), "INTERCEPT", 0.5) for d in days], "MODEL string, DATE date, FACTOR_NAME string, RETURN double")
    ret = spark.createDataFrame([(str(s), day(k), float(r[k, s])) for k in range(8) for s in range(3) if (k, s) != (7, 2)], "SECURITY_ID string, DATE date, ONE_DAY_PCT double")
    long = spark.createDataFrame([("M", day(k), str(s), n, float(beta[k, s, j])) for k in range(8) for s in range(3) for j, n in enumerate(names)], "MODEL string, DATE date, SECURITY_ID string, FACTOR_NAME string, EXPOSURE double")
    got = {(x.DATE, x.SECURITY_ID): x.SPECIFIC_VAR for x in covariance.specific_risk(long, ret, factors, SMALL).collect()}
    want = {}
    for i in range(3, 6):
        sigma = np.cov(fr[i - 3 : i + 1].T)
        for s in range(3):
            seen = [r[k, s] for k in range(days[i - 3], days[i] + 1) if (k, s) != (7, 2)]
            total, form = np.var(seen, ddof=1), beta[days[i], s] @ sigma @ beta[days[i], s]
            want[day(days[i]), str(s)] = max(total - (0.95 * total if form >= total else form), 0.01 * total, 1e-8)
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()))


def test_geography(spark):
    df = spark.createDataFrame([(c,) for c in (" usa ", "UK", None, "", "Atlantis", "Israel", "Australia")], "COUNTRY string")
    want = ["North America Developed", "Europe Developed", "Unknown Unknown", "Unknown Unknown", "Unknown Unknown", "Middle East Developed", "Asia Developed"]
    assert [r[0] for r in df.select(geo.continent_developed(F.col("COUNTRY"))).collect()] == want
    assert sorted(r.CONTINENT for r in geo.with_geography(df).collect()) == sorted(want)
    assert len(geo.country_rows()) == 56 and len(geo.DEVELOPED) == 29


def test_currency(spark):
    amounts = spark.createDataFrame([(0, DAY, "USD", 10.0), (1, DAY, "EUR", 10.0), (2, DAY, "XXX", 10.0), (3, day(9), "EUR", 10.0)], "k int, DATE date, CURRENCY string, A double")
    rates = spark.createDataFrame([(DAY, "EUR", 1.5), (day(1), "EUR", 2.0)], "DATE date, CURRENCY string, EXCHANGE_RATE_TO_USD double")
    assert [r.A for r in fx.to_usd_dated(amounts, rates, "A").orderBy("k").collect()] == [10.0, 15.0, 10.0, 10.0]
    assert [r.A for r in fx.to_usd_latest(amounts, rates, "A").orderBy("k").collect()] == [10.0, 20.0, 10.0, 20.0]


def test_calendar(spark):
    got = calendar.quarters_in_range(spark, "2019-12-31", "2020-04-01").orderBy("first_day").collect()
    assert [(r.year, r.quarter) for r in got] == [(2019, 4), (2020, 1), (2020, 2)]
    assert got[1].last_day == datetime.date(2020, 3, 31)


def test_warehouse(spark, tmp_path):
    prices = spark.createDataFrame([("A", "2020-01-01", 1.0, False), ("A", "2020-01-02", 2.0, True), ("B", "2020-01-03", math.nan, False)], "FACTSET_ID string, P_DATE string, ADJUSTED_PRICE double, IS_HOLIDAY boolean")
    universe = spark.createDataFrame([("A", "USA", "Tech"), ("A", "USA", "Tech"), ("B", None, None)], "FACTSET_ID string, COUNTRY string, SECTOR string")
    house = Warehouse(spark, tables={"prices": prices, "universe": universe})
    assert canonical(prices).filter("ADJUSTED_PRICE is null").count() == 1
    assert house.universe().count() == 2 and house.prices(ids=["A"]).count() == 2
    assert [r.DATE for r in house.trading_dates("2020-01-01", "2020-12-31").collect()] == ["2020-01-01", "2020-01-03"]
    assert [house.is_holiday(d).first()[0] for d in ("2020-01-01", "2020-01-02", "2020-01-09")] == [False, True, True]
    assert [r.SECURITY_ID for r in house.sample_ids(1).collect()] == [r.SECURITY_ID for r in house.sample_ids(1).collect()]
    with pytest.raises(ValueError):
        canonical(spark.range(1))
    with pytest.raises(NotImplementedError):
        ModelConfig(neutralize=True)
    with pytest.raises(RuntimeError):
        house.query("select nothing from nowhere")
    assert house.query("select :x as x", x=3).first().x == 3


def test_factor_names(spark):
    names = ["SECTOR_Oil_Gas", "VALUE", "CONTINENT_North_America_Developed", "INTERCEPT", "OTHER"]
    df = spark.createDataFrame([(n,) for n in names], "FACTOR_NAME string")
    got = [(r.FACTOR_DISPLAY_NAME, r.FACTOR_GROUP) for r in metadata.factor_names(df, ModelConfig()).collect()]
    assert got == [("VALUE", "Style Factors"), ("Oil Gas Sector", "Sector Factors"), ("North America Developed", "Geographic Factors"), ("Intercept", "Market Factor")]


def test_download_and_read_again(spark, tmp_path):
    prices = spark.createDataFrame([("A", day(k), 10.0 + k, 5.0, False) for k in range(6)], "SECURITY_ID string, DATE date, ADJUSTED_PRICE double, ADJUSTED_VOLUME double, IS_HOLIDAY boolean")
    fundamentals = spark.createDataFrame([("A", day(k), 1.0) for k in range(6)], "SECURITY_ID string, DATE date, SALES_LTM double")
    universe = spark.createDataFrame([("A", "Canada", "Tech")], "SECURITY_ID string, COUNTRY string, SECTOR string")
    Warehouse(spark, tables={"prices": prices, "fundamentals": fundamentals, "universe": universe, "returns": returns.daily_returns(prices)}).download("2020-01-03", "2020-01-05", str(tmp_path))
    with Warehouse(spark, folder=str(tmp_path)) as house:
        assert house.returns().count() == 4 and house.fundamentals().count() == 3
        assert house.universe().first().CONTINENT == "North America Developed"
    with pytest.raises(ConnectionError):
        Warehouse(spark).connect()


def test_cut_tables_go_with_clear(spark):
    import os

    from quillon.plans import lineage

    made = lineage.cut(spark.range(3))
    path = lineage._WRITTEN[-1].removeprefix("file:")
    assert made.count() == 3 and os.path.isdir(path)
    lineage.clear(spark)
    assert not os.path.exists(path) and not lineage._WRITTEN


def test_command_line(spark, tmp_path):
    from quillon.__main__ import main

    rng = np.random.default_rng(4)
    ids, days = [f"S{k}" for k in range(12)], [day(k) for k in range(90)]
    spark.createDataFrame([(i, d, float(rng.uniform(5, 9)), 5.0, False) for i in ids for d in days], "SECURITY_ID string, DATE date, ADJUSTED_PRICE double, ADJUSTED_VOLUME double, IS_HOLIDAY boolean").write.parquet(f"{tmp_path}/prices.parquet")
    names = ("SALES_LTM", "SALES_NTM", "COGS_LTM", "EBITDA_LTM", "EBITDA_NTM", "EPS_LTM", "EPS_NTM")
    spark.createDataFrame([(i, d, *map(float, rng.uniform(1, 9, 7))) for i in ids for d in days], f"SECURITY_ID string, DATE date, {', '.join(f'{n} double' for n in names)}").write.parquet(f"{tmp_path}/fundamentals.parquet")
    spark.createDataFrame([(i, "Canada" if k % 2 else "Japan", "Tech" if k % 3 else "Energy") for k, i in enumerate(ids)], "SECURITY_ID string, COUNTRY string, SECTOR string").write.parquet(f"{tmp_path}/universe.parquet")
    main(["--start", str(days[60]), "--end", str(days[-1]), "--data", str(tmp_path), "--output", f"{tmp_path}/out"])
    exposures = spark.read.parquet(f"{tmp_path}/out/exposures.parquet")
    assert exposures.select("DATE").distinct().count() == 30
    assert {r[0] for r in exposures.select("FACTOR_NAME").distinct().collect()} >= {"VALUE", "VOLATILITY", "SECTOR_Tech", "CONTINENT_Asia_Developed"}
    with pytest.raises(NotImplementedError):
        main(["--neutralize"])


def test_specific_risk_skips_and_unknown_covariance(spark):
    """By hand: a security that knows no factor with returns has no row; an unknown covariance makes the whole factor variance zero."""
    cfg = ModelConfig(risk=4, covariance_least=2)
    rng = np.random.default_rng(5)
    r, fr = rng.normal(0, 0.02, (4, 3)), rng.normal(0, 0.01, (4, 2))
    factors = spark.createDataFrame([("M", day(k), n, float(fr[k, j])) for k in range(4) for j, n in enumerate("AB") if (n, k) not in (("B", 0), ("B", 1), ("B", 2))], "MODEL string, DATE date, FACTOR_NAME string, RETURN double")
    ret = spark.createDataFrame([(str(s), day(k), float(r[k, s])) for k in range(4) for s in range(3)], "SECURITY_ID string, DATE date, ONE_DAY_PCT double")
    wide = spark.createDataFrame([(str(s), day(3), *x) for s, x in enumerate([(1.5, None, 7.0), (None, None, 7.0), (1.5, 2.0, None)])], "SECURITY_ID string, DATE date, A double, B double, WITHOUT_RETURNS double")
    got = {x.SECURITY_ID: x.SPECIFIC_VAR for x in covariance.specific_risk(wide, ret, factors, cfg).collect()}
    total = [np.var(r[:, s], ddof=1) for s in range(3)]
    form = 1.5**2 * np.var(fr[:, 0], ddof=1)
    assert got.keys() == {"0", "2"}
    assert np.isclose(got["0"], max(total[0] - (0.95 * total[0] if form >= total[0] else form), 0.01 * total[0])) and np.isclose(got["2"], total[2])


def test_whole_model_against_numpy(spark):
    """All kinds of factors, dummies that are linearly dependent: returns, specific returns, covariance and risk by numpy."""
    rng = np.random.default_rng(9)
    n, days, names = 30, 14, ["VALUE", "GROWTH", "SECTOR_a", "SECTOR_b", "SECTOR_c", "CONTINENT_x", "CONTINENT_y"]
    sector, place = rng.integers(0, 3, n), rng.integers(0, 2, n)
    beta = np.zeros((days, n, 7))
    beta[:, :, :2] = rng.normal(size=(days, n, 2))
    for k in range(3):
        beta[:, :, 2 + k] = (sector == k) - (sector == k).mean()
    for k in range(2):
        beta[:, :, 5 + k] = (place == k) - (place == k).mean()
    r = rng.normal(0, 0.02, (days, n))
    wide = spark.createDataFrame([(f"S{s:02}", day(d), *map(float, beta[d, s])) for d in range(days) for s in range(n)], f"SECURITY_ID string, DATE date, {', '.join(f'{x} double' for x in names)}").repartition(5)
    ret = spark.createDataFrame([(f"S{s:02}", day(d), float(r[d, s])) for d in range(days) for s in range(n)], "SECURITY_ID string, DATE date, ONE_DAY_PCT double").repartition(3)
    cfg = ModelConfig(covariance=6, covariance_least=3, risk=6)
    factors = regression.factor_returns(wide, ret, names, cfg).cache()
    got = {(x.DATE, x.FACTOR_NAME): x.RETURN for x in factors.collect()}
    want = np.array([np.linalg.pinv(np.column_stack([np.ones(n), beta[d]])) @ r[d] for d in range(days)])
    assert np.allclose([[got[day(d), f] for f in ["INTERCEPT", *names]] for d in range(days)], want)
    left = {(x.DATE, x.SECURITY_ID): x.SPECIFIC_RETURN for x in regression.specific_returns(wide, ret, factors, cfg).collect()}
    assert np.allclose([[left[day(d), f"S{s:02}"] for s in range(n)] for d in range(days)], r - np.einsum("dsf,df->ds", beta, want[:, 1:]))
    cov = {(x.DATE, x.FACTOR_NAME_1, x.FACTOR_NAME_2): x.COVARIANCE for x in covariance.factor_covariance(factors, cfg).collect()}
    every = ["INTERCEPT", *names]
    assert len(cov) == (days - 2) * 36
    for d in range(2, days):
        sigma = np.cov(want[max(0, d - 5) : d + 1].T)
        assert all(np.isclose(cov[day(d), *sorted((every[i], every[j]))], sigma[i, j], atol=1e-15) for i in range(8) for j in range(8))
    risk = {(x.DATE, x.SECURITY_ID): x.SPECIFIC_VAR for x in covariance.specific_risk(wide, ret, factors, cfg).collect()}
    assert len(risk) == (days - 5) * n
    for d in range(5, days):
        sigma = np.cov(want[d - 5 : d + 1, 1:].T)
        for s in range(n):
            total, form = np.var(r[d - 5 : d + 1, s], ddof=1), beta[d, s] @ sigma @ beta[d, s]
            assert np.isclose(risk[day(d), f"S{s:02}"], max(total - (0.95 * total if form >= total else form), 0.01 * total, 1e-8))
