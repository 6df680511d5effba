"""The engine's queries over the weekly sample, and SQL that gives the same rows. Values are rounded to six decimals."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.functions import calendar, fx, geo
from quillon.functions.scalars import iso
from quillon.operators import characteristics as ch
from quillon.operators import covariance, crosssection, metadata, regression, rolling
from quillon.plans.config import WEEKLY, ModelConfig
from quillon.plans.lineage import cut, shared_dir
from quillon.plans.model import Exposures, build_exposures, live_factors
from quillon.sources.schemas import DATE, ID, OUTPUTS
from quillon.sources.sinks import write_outputs
from quillon.sources.warehouse import Warehouse
from quillon.sources.weekly import SECTORS, weekly_tables
from quillon.streaming import rolling as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CFG = WEEKLY
KEYS = (DATE, ID)


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def shown(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Dates as text, doubles rounded."""
    out = df.select(*columns) if columns else df
    return out.select(*[iso(c).alias(c) if kind == "date" else (F.round(c, 6) + 0.0).alias(c) if kind == "double" else F.col(c) for c, kind in out.dtypes])


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 as {n}" for n in names)


_DAY = "strftime(DATE, '%Y-%m-%d') as DATE"


def _rolled(cfg: ModelConfig) -> str:
    return f"""rolled as (select SECURITY_ID, "DATE", case when row_number() over w >= {cfg.momentum + cfg.momentum_skip}
        then product(1 + r) over (partition by SECURITY_ID order by "DATE" rows between {cfg.momentum + cfg.momentum_skip + cfg.momentum_slack - 1} preceding and {cfg.momentum_skip} preceding)
           - product(1 + r) over (partition by SECURITY_ID order by "DATE" rows between {cfg.momentum_skip - 1} preceding and current row) end MOMENTUM,
      case when row_number() over w >= {cfg.volatility} then stddev_samp(r) over (partition by SECURITY_ID order by "DATE" rows between {cfg.volatility - 1} preceding and current row) end VOLATILITY,
      last_value(case when dv > 0 and cnt = {cfg.liquidity} then ln(mean_dv) end ignore nulls) over (partition by SECURITY_ID order by "DATE" rows between unbounded preceding and current row) LIQUIDITY
      from (select *, count(*) over l cnt, avg(dv) over l mean_dv from feed window l as (partition by SECURITY_ID, dv > 0 order by "DATE" rows between {cfg.liquidity - 1} preceding and current row))
      window w as (partition by SECURITY_ID order by "DATE"))"""


_SECTOR = "case s_suppkey % 6 " + " ".join(f"when {k} then '{s}'" for k, s in enumerate(SECTORS)) + " end"
#: The steps that the queries share, each a CTE.
_STEPS = {
    "base": """base as (select l_suppkey k, cast(date_trunc('week', l_shipdate) as date) "DATE", sum(l_extendedprice) ext, sum(l_quantity) qty, sum(l_extendedprice * (1 - l_discount)) s_ltm,
      sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) s_ntm, sum(l_quantity * p_retailprice) cogs from lineitem join part on l_partkey = p_partkey group by 1, 2)""",
    "prices": """prices as (select concat('S', k) SECURITY_ID, "DATE", ext / nullif(qty, 0) px, qty vol from base)""",
    "fund": """fund as (select concat('S', k) SECURITY_ID, "DATE", s_ltm, s_ntm, cogs, s_ltm - cogs e_ltm, s_ntm - cogs e_ntm, (s_ltm - cogs) / nullif(qty, 0) eps_ltm, (s_ntm - cogs) / nullif(qty, 0) eps_ntm from base)""",
    "univ": f"""univ as (select concat('S', s_suppkey) SECURITY_ID, {_SECTOR} SECTOR, concat(r_name, case when n_nationkey % 2 = 0 then ' Developed' else ' Developing' end) CONTINENT
      from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
    "rets": """rets as (select * from (select SECURITY_ID, "DATE", px / nullif(lag(px) over (partition by SECURITY_ID order by "DATE"), 0) - 1 r from prices) where r is not null)""",
    "feed": """feed as (select SECURITY_ID, "DATE", r, px * vol dv from rets join prices using (SECURITY_ID, "DATE"))""",
    "rolled": _rolled(CFG),
    "chars": """chars as (select SECURITY_ID, "DATE", SECTOR, CONTINENT, case when eps_ntm > 0 then eps_ntm / nullif(px, 0) end EY_NTM, s_ntm / nullif(px, 0) SY_NTM, case when e_ntm > 0 then e_ntm / nullif(px, 0) end EBITDA_Y_NTM,
      case when eps_ltm > 0 then eps_ltm / nullif(px, 0) end EY_LTM, s_ltm / nullif(px, 0) SY_LTM, case when s_ltm > 0 then e_ltm / s_ltm end EBITDA_MARGIN, case when s_ltm > 0 and cogs > 0 then 1 - cogs / s_ltm end GROSS_MARGIN,
      case when eps_ltm > 0 then eps_ntm / eps_ltm - 1 end EPS_GROWTH, case when s_ltm > 0 then s_ntm / s_ltm - 1 end SALES_GROWTH from fund join prices using (SECURITY_ID, "DATE") join univ using (SECURITY_ID))""",
    "panel": """panel as (select * from (select chars.*, k.SECURITY_ID id, k."DATE" d, """
    + ", ".join(f"""last_value(rolled.{c} ignore nulls) over (partition by k.SECURITY_ID order by k."DATE" rows between unbounded preceding and current row) {c}""" for c in crosssection.ROLLING)
    + """ from (select SECURITY_ID, "DATE" from chars union select SECURITY_ID, "DATE" from rolled) k left join chars on chars.SECURITY_ID = k.SECURITY_ID and chars."DATE" = k."DATE"
      left join rolled on rolled.SECURITY_ID = k.SECURITY_ID and rolled."DATE" = k."DATE") where SECURITY_ID is not null)""",
    "wins": """wins as (select SECURITY_ID, "DATE", SECTOR, CONTINENT, """ + ", ".join(f"case when {c} is not null then least(greatest({c}, lo_{c}), hi_{c}) end {c}" for c in crosssection.CHARACTERISTICS)
    + """ from panel join (select "DATE", """ + ", ".join(f"quantile_cont({c}, 0.01) lo_{c}, quantile_cont({c}, 0.99) hi_{c}" for c in crosssection.CHARACTERISTICS) + """ from panel group by 1) using ("DATE"))""",
    "zs": """zs as (select SECURITY_ID, "DATE", SECTOR, CONTINENT, """ + ", ".join(f"case when s_{c} > 0 then ({c} - m_{c}) / s_{c} else {c} end {c}" for c in crosssection.CHARACTERISTICS)
    + """ from wins join (select "DATE", """ + ", ".join(f"avg({c}) m_{c}, stddev_samp({c}) s_{c}" for c in crosssection.CHARACTERISTICS) + """ from wins group by 1) using ("DATE"))""",
    "comp": """comp as (select *, """ + ", ".join(f"list_avg([{', '.join(m)}]) {k}" for k, m in crosssection.COMPOSITES.items()) + " from zs)",
    "styles": """styles as (select SECURITY_ID, "DATE", SECTOR, CONTINENT, """ + ", ".join(f"case when s_{c} > 0 then ({c} - m_{c}) / s_{c} else {c} end {c}" for c in crosssection.COMPOSITES) + ", " + ", ".join(crosssection.ROLLING)
    + """ from comp join (select "DATE", """ + ", ".join(f"avg({c}) m_{c}, stddev_samp({c}) s_{c}" for c in crosssection.COMPOSITES) + """ from comp group by 1) using ("DATE"))""",
    "dum": """dum as (select r.SECURITY_ID, r."DATE", v.name, case when v.val = case v.kind when 'SECTOR' then r.SECTOR else r.CONTINENT end then 1 else 0 end - n * 1.0::double / total x, v.kind
      from styles r join (select distinct 'SECTOR' kind, SECTOR val, 'SECTOR_' || replace(SECTOR, ' ', '_') name from univ union select distinct 'CONTINENT', CONTINENT, 'CONTINENT_' || replace(CONTINENT, ' ', '_') from univ) v on true
      join (select "DATE", count(*) total from styles group by 1) t on t."DATE" = r."DATE"
      join (select d."DATE", v.val, v.kind, count(s.SECURITY_ID) n from (select distinct "DATE" from styles) d join (select distinct 'SECTOR' kind, SECTOR val from univ union select distinct 'CONTINENT', CONTINENT from univ) v on true
        left join styles s on s."DATE" = d."DATE" and case v.kind when 'SECTOR' then s.SECTOR else s.CONTINENT end = v.val group by 1, 2, 3) c on c."DATE" = r."DATE" and c.val = v.val and c.kind = v.kind)""",
    "fit1": """fit1 as (select "DATE", regr_slope(r, VALUE) b, regr_intercept(r, VALUE) a from styles join rets using (SECURITY_ID, "DATE") where VALUE is not null group by 1 having count(*) >= 3)""",
    "mom2": """mom2 as (select "DATE", count(*) n, avg(r) my, avg(VALUE) m1, avg(GROWTH) m2, var_samp(VALUE) v1, var_samp(GROWTH) v2, covar_samp(VALUE, GROWTH) v12, covar_samp(r, VALUE) c1, covar_samp(r, GROWTH) c2
      from styles join rets using (SECURITY_ID, "DATE") where VALUE is not null and GROWTH is not null group by 1 having count(*) >= 4)""",
    "fit2": """fit2 as (select "DATE", (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) b2, my - m1 * (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) - m2 * (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) a from mom2)""",
    "fr": """fr as (select "DATE", 'INTERCEPT' f, a x from fit2 union all select "DATE", 'VALUE', b1 from fit2 union all select "DATE", 'GROWTH', b2 from fit2)""",
    "idx": """idx as (select "DATE", row_number() over (order by "DATE") - 1 idx from fit2)""",
    "spec": """spec as (select s.SECURITY_ID, s."DATE", r - coalesce(VALUE * b1, 0) - coalesce(GROWTH * b2, 0) e from styles s join rets r on r.SECURITY_ID = s.SECURITY_ID and r."DATE" = s."DATE" join fit2 on fit2."DATE" = s."DATE" where VALUE is not null or GROWTH is not null)""",
    "tv": f"""tv as (select * from (select SECURITY_ID, "DATE", own, idx, var_samp(r) over w v, count(r) over w n from (
        select coalesce(s.SECURITY_ID, r.SECURITY_ID) SECURITY_ID, coalesce(s."DATE", r."DATE") "DATE", s.SECURITY_ID is not null own, r from (select SECURITY_ID, "DATE" from styles where VALUE is not null or GROWTH is not null) s full join rets r on r.SECURITY_ID = s.SECURITY_ID and r."DATE" = s."DATE") p
      join (select d."DATE", idx.idx, case when idx.idx is not null then 2 * idx.idx else 2 * last_value(idx.idx ignore nulls) over (order by d."DATE" rows between unbounded preceding and current row) + 1 end pos
        from (select "DATE" from styles union select "DATE" from rets) d left join idx on idx."DATE" = d."DATE") q using ("DATE") where pos is not null
      window w as (partition by SECURITY_ID order by pos range between {2 * (CFG.risk - 1)} preceding and current row)) where own and idx >= {CFG.risk - 1} and n >= {CFG.risk // 2} and v > 0)""",
    "cov60": f"""cov60 as (select "DATE", idx, var_samp(b1) over w c11, var_samp(b2) over w c22, covar_samp(b1, b2) over w c12 from fit2 join idx using ("DATE") window w as (order by idx rows between {CFG.risk - 1} preceding and current row))""",
    "fv": f"""fv as (select s.SECURITY_ID, s."DATE", coalesce(VALUE, 0) * coalesce(VALUE, 0) * c11 + coalesce(GROWTH, 0) * coalesce(GROWTH, 0) * c22 + 2 * coalesce(VALUE, 0) * coalesce(GROWTH, 0) * c12 v from styles s join cov60 c on c."DATE" = s."DATE" where c.idx >= {CFG.risk - 1} and (VALUE is not null or GROWTH is not null))""",
}


def _with(last: str, select: str) -> str:
    """``select`` after all steps up to ``last``."""
    names = list(_STEPS)
    return "with " + ",\n".join(_STEPS[n] for n in names[: names.index(last) + 1]) + "\n" + select


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return weekly_tables(spark, sf)


def _warehouse(spark: SparkSession, sf: str) -> Warehouse:
    return Warehouse(spark, tables={k: v for k, v in _tables(spark, sf).items() if k != "returns"}, config=type(CFG)(min_date="1990-01-01"))


# Sources


@query(_with("prices", f"""select SECURITY_ID, {_DAY}, round(px, 6) + 0.0 as ADJUSTED_PRICE, round(vol, 6) + 0.0 as ADJUSTED_VOLUME from prices where "DATE" between date '1997-01-01' and date '1998-12-31'"""))
def prices_panel(spark, sf):
    return shown(_warehouse(spark, sf).prices_by_date_range("1997-01-01", "1998-12-31"), ID, DATE, "ADJUSTED_PRICE", "ADJUSTED_VOLUME")


@query(_with("prices", f"""select distinct {_DAY} from prices where "DATE" between date '1997-01-01' and date '1998-12-31'"""))
def trading_dates(spark, sf):
    return _warehouse(spark, sf).trading_dates("1997-01-01", "1998-12-31")


@query("""select d as DATE, not exists (select 1 from lineitem where cast(date_trunc('week', l_shipdate) as date) = cast(d as date)) as IS_HOLIDAY from (values ('1997-01-06'), ('1997-01-07')) t(d)""")
def holiday_flag(spark, sf):
    house = _warehouse(spark, sf)
    one = lambda d: house.is_holiday(d).select(F.lit(d).alias(DATE), "IS_HOLIDAY")
    return one("1997-01-06").unionByName(one("1997-01-07"))


@query(_with("prices", f"""select SECURITY_ID, {_DAY}, round(px, 6) + 0.0 as ADJUSTED_PRICE from prices where SECURITY_ID in ('S1', 'S3', 'S5')"""))
def id_semi_filter(spark, sf):
    return shown(_warehouse(spark, sf).prices(ids=["S1", "S3", "S5"]), ID, DATE, "ADJUSTED_PRICE")


#: Sums of money over whole numbers are often half-way between two roundings, where the order of addition would decide; both sides
#: move them off by this.
_OFF = 1e-9


@query(_with("fund", f"""select SECURITY_ID, {_DAY}, round(s_ltm + {_OFF}, 4) as SALES_LTM, round(eps_ltm + {_OFF}, 4) as EPS_LTM from fund where "DATE" between date '1997-01-01' and date '1997-12-31'"""))
def fundamentals_panel(spark, sf):
    df = _warehouse(spark, sf).fundamentals_by_date_range("1997-01-01", "1997-12-31")
    return df.select(ID, iso(DATE).alias(DATE), *[F.round(F.col(c) + _OFF, 4).alias(c) for c in ("SALES_LTM", "EPS_LTM")])


@query(_with("univ", "select SECURITY_ID, SECTOR, CONTINENT from univ"))
def universe_continent(spark, sf):
    return _warehouse(spark, sf).universe().select(ID, "SECTOR", "CONTINENT")


_PLACES = (" usa ", "UK", None, "", "Atlantis", "Israel", "AUSTRALIA", "south korea", "Brazil", "Kenya")
_PLACE_SQL = ", ".join("(null)" if p is None else f"('{p}')" for p in _PLACES)


@query(
    "with t(c, k, a, s) as (select * from (values " + ", ".join(f"('{c}', '{c.lower()}', '{a}', '{s}')" for c, a, s in geo.country_rows()) + ")), p(COUNTRY) as (values " + _PLACE_SQL + """)
select COUNTRY, coalesce(a, 'Unknown') as CONTINENT, coalesce(s, 'Unknown') as STATUS, case when a is null then 'Unknown Unknown' else a || ' ' || s end as REGION from p left join t on lower(trim(COUNTRY)) = k"""
)
def geography(spark, sf):
    df = spark.createDataFrame([(p,) for p in _PLACES], "COUNTRY string")
    c = F.col("COUNTRY")
    return df.select(c, geo.continent(c).alias("CONTINENT"), geo.developed_status(c).alias("STATUS"), geo.continent_developed(c).alias("REGION"))


@query("""select cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, strftime(d, '%Y-%m-%d') as first_day, strftime(d + interval 3 months - interval 1 day, '%Y-%m-%d') as last_day
from (select unnest(generate_series(timestamp '1996-10-01', timestamp '1998-02-15', interval 3 months)) d)""")
def quarter_list(spark, sf):
    return shown(calendar.quarters_in_range(spark, "1996-11-20", "1998-02-15"))


_FX_SQL = """with rates as (select cast(o_orderdate as date) d, ['EUR', 'GBP', 'JPY'][1 + cast(o_orderkey % 3 as integer)] c, avg(o_totalprice) / 100000 as rate from orders group by 1, 2),
amounts as (select o_orderkey k, cast(o_orderdate as date) d, ['EUR', 'USD', 'GBP', 'CHF'][1 + cast(o_orderkey % 4 as integer)] c, o_totalprice x from orders)
"""


def _fx(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    pick = lambda names: F.get(F.array(*map(F.lit, names)), (F.col("o_orderkey") % len(names)).cast("int")).alias("CURRENCY")
    day = F.to_date("o_orderdate").alias(DATE)
    rates = orders.groupBy(day, pick(("EUR", "GBP", "JPY"))).agg((F.avg("o_totalprice") / 100000).alias(fx.RATE))
    return orders.select("o_orderkey", day, pick(("EUR", "USD", "GBP", "CHF")), F.col("o_totalprice").alias("AMOUNT")), rates


@query(_FX_SQL + """select k as o_orderkey, round(x * case when amounts.c = 'USD' then 1.0::double else coalesce(rate, 1.0::double) end, 2) as AMOUNT from amounts left join rates on rates.d = amounts.d and rates.c = amounts.c""")
def fx_convert_dated(spark, sf):
    amounts, rates = _fx(spark, sf)
    return fx.to_usd_dated(amounts, rates, "AMOUNT").select("o_orderkey", F.round("AMOUNT", 2).alias("AMOUNT"))


@query(_FX_SQL + """select k as o_orderkey, round(x * case when amounts.c = 'USD' then 1.0::double else coalesce(rate, 1.0::double) end, 2) as AMOUNT from amounts left join (select c, arg_max(rate, d) rate from rates group by 1) r on r.c = amounts.c""")
def fx_convert_latest(spark, sf):
    amounts, rates = _fx(spark, sf)
    return fx.to_usd_latest(amounts, rates, "AMOUNT").select("o_orderkey", F.round("AMOUNT", 2).alias("AMOUNT"))


def _house_with(spark, sf, **tables) -> Warehouse:
    house = _warehouse(spark, sf)
    house.tables |= tables
    return house


@query(_with("prices", f"""select SECURITY_ID, {_DAY}, round(px * vol, 4) as MARKETCAP from prices where SECURITY_ID in ('S2', 'S4') and "DATE" between date '1996-01-01' and date '1997-12-31'"""))
def market_value_filter(spark, sf):
    prices = _tables(spark, sf)["prices"]
    caps = prices.select(ID, DATE, "CURRENCY", (F.col("ADJUSTED_PRICE") * F.col("ADJUSTED_VOLUME")).alias("MARKETCAP"))
    return _house_with(spark, sf, market_value=caps).market_value("1996-01-01", "1997-12-31", ["S2", "S4"]).select(ID, iso(DATE).alias(DATE), F.round("MARKETCAP", 4).alias("MARKETCAP"))


@query(_with("fund", """select SECURITY_ID as ticker, strftime("DATE", '%Y-%m-%d') as date, 'close' as field, round(px, 6) + 0.0 as value from prices where SECURITY_ID in ('S1', 'S2') and "DATE" between date '1997-01-01' and date '1997-06-30'
union all select SECURITY_ID, strftime("DATE", '%Y-%m-%d'), 'revenue', round(s_ltm, 6) + 0.0 from fund where SECURITY_ID in ('S1', 'S2') and "DATE" between date '1997-01-01' and date '1997-06-30'"""))
def stock_data(spark, sf):
    t = _tables(spark, sf)
    keyed = lambda df: df.withColumnsRenamed({ID: "ticker", DATE: "date"})
    house = _house_with(spark, sf, ohlcv=keyed(t["prices"]).withColumnRenamed("ADJUSTED_PRICE", "close"), legacy_fundamentals=keyed(t["fundamentals"]).withColumnRenamed("SALES_LTM", "revenue"))
    halves = house.stock_data(["S1", "S2"], "1997-01-01", "1997-06-30")
    prices, fundamentals = (shown(df, "ticker", "date", F.lit(c).alias("field"), F.col(c).alias("value")) for df, c in zip(halves, ("close", "revenue"), strict=True))
    return prices.unionByName(fundamentals)


@query(_with("prices", f"""select {_DAY}, round(r, 6) + 0.0 as ONE_DAY_PCT from (select "DATE", px / nullif(lag(px) over (order by "DATE"), 0) - 1 r from (select "DATE", avg(px) px from prices where "DATE" between date '1996-01-01' and date '1999-12-31' group by 1)) where r is not null"""))
def index_returns(spark, sf):
    level = _tables(spark, sf)["prices"].groupBy(DATE).agg(F.avg("ADJUSTED_PRICE").alias("ADJUSTED_PRICE")).withColumn(ID, F.lit("INDEX"))
    return shown(_house_with(spark, sf, index_prices=level).index_returns("1996-01-01", "1999-12-31"))


def _values(spark, sf):
    """Market value, enterprise value and exchange rates of the sample: price times volume, a fifth more, and the orders' rates."""
    prices = _tables(spark, sf)["prices"]
    cap = F.col("ADJUSTED_PRICE") * F.col("ADJUSTED_VOLUME")
    rates = _fx(spark, sf)[1].withColumnsRenamed({"CURRENCY": "CURRENCYCODE", fx.RATE: "EXCHANGERATE"})
    return {"market_value": prices.select(ID, DATE, "CURRENCY", cap.alias("MARKETCAP")), "enterprise_value": prices.select(ID, DATE, (cap * 1.2).alias("ENTERPRISE_VALUE"), F.col(DATE).alias("EV_COMPONENTS_DATE")), "exchange_rates": rates}


def _counts(tables: dict[str, DataFrame], **more) -> DataFrame:
    """A row for each table: its name, its rows, and the columns ``more``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(*[F.lit(v).alias(k) for k, v in more.items()], F.lit(k).alias("name"), "n") for k, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


_SIX = ("prices", "fundamentals", "universe", "exchange_rates", "market_value", "enterprise_value")
_RATES = "rates as (select cast(o_orderdate as date) d, o_orderkey % 3 c, avg(o_totalprice) / 100000 as rate from orders group by 1, 2)"


@query(_with("prices", f""", {_RATES} select d as day, name, case when n = 0 then 0 when name = 'exchange_rates' then (select count(*) from rates where rates.d = cast(x.d as date)) else n end as n
from (select d, (select count(*) from prices where "DATE" = cast(d as date)) n from (values ('1997-01-06'), ('1997-01-07')) t(d)) x, (select unnest({list(_SIX)}) as name)"""))
def data_for_date(spark, sf):
    """All six tables on a trading day and on one without prices."""
    house = _house_with(spark, sf, **_values(spark, sf))
    days = [_counts({k: house.data_for_date(d)[k] for k in _SIX}, day=d) for d in ("1997-01-06", "1997-01-07")]
    return days[0].unionByName(days[1])


@query(_with("rets", """select strftime("DATE", '%Y-%m-%d') as DATE from (select "DATE" from fund intersect select "DATE" from rets)"""))
def common_dates(spark, sf):
    t = _tables(spark, sf)
    return t["fundamentals"].select(iso(DATE).alias(DATE)).intersect(t["returns"].select(iso(DATE).alias(DATE)))


@query(_with("rets", f"""select SECURITY_ID, {_DAY}, count(r) over w as held, round(first_value(r) over w, 6) + 0.0 as oldest, round(r, 6) + 0.0 as newest from rets window w as (partition by SECURITY_ID order by "DATE" rows between 4 preceding and current row)"""))
def ring_buffer(spark, sf):
    df = rolling.ring_values(_tables(spark, sf)["returns"], "ONE_DAY_PCT", 5)
    return shown(df, ID, DATE, F.size("BUFFER").cast("long").alias("held"), F.element_at("BUFFER", 1).alias("oldest"), F.element_at("BUFFER", -1).alias("newest"))


_YEAR = """where "DATE" between date '1997-01-01' and date '1997-12-31'"""


@query(_with("univ", f""", {_RATES}, y as (select *, row_number() over (partition by SECURITY_ID order by "DATE") k, lag(px) over (partition by SECURITY_ID order by "DATE") before from prices {_YEAR})
select 'universe' as name, count(*) as n from univ union all select 'prices', count(*) from y union all select 'fundamentals', count(*) from y union all select 'returns', count(*) from y where px / nullif(before, 0) is not null
union all select 'exchange_rates', count(*) from rates where d between date '1997-01-01' and date '1997-12-31' union all select 'market_value', count(*) from y union all select 'enterprise_value', count(*) from y"""))
def all_data_counts(spark, sf):
    """Rows of the seven tables, for all securities."""
    house = _house_with(spark, sf, **_values(spark, sf))
    house.config = type(CFG)(min_date="1990-01-01", max_stocks=None)
    return _counts(house.all_data("1997-01-01", "1997-12-31"))


@query("select least(50, count(*)) as n, least(50, count(*)) as n_distinct, least(50, count(*)) as n_known, true as again from supplier")
def sample_ids(spark, sf):
    """A seeded sample of securities: how many, how many of them different and in the universe, and whether a second run has the same."""
    house = _warehouse(spark, sf)
    tagged = lambda df, **n: df.select(ID, *[F.lit(n.get(c, 0)).alias(c) for c in "sau"])
    every = tagged(house.sample_ids(50), s=1).unionByName(tagged(house.sample_ids(50), a=1)).unionByName(tagged(house.universe(), u=1))
    each = every.groupBy(ID).agg(*[F.sum(c).alias(c) for c in "sau"])
    return each.agg(F.sum("s").alias("n"), F.count_if(F.col("s") > 0).alias("n_distinct"), F.count_if((F.col("s") > 0) & (F.col("u") > 0)).alias("n_known"), F.bool_and(F.col("s") == F.col("a")).alias("again"))


@query(_with("prices", """select SECURITY_ID, count(*) as n, round(max(px), 6) + 0.0 as high from prices where px > 1000.0::double group by 1"""))
def warehouse_sql(spark, sf):
    """An SQL text with a bound value, in an open session on the warehouse."""
    with _warehouse(spark, sf) as house:
        house.table("prices").createOrReplaceTempView("weekly_prices")
        return house.query(f"select {ID}, count(*) as n, round(max(ADJUSTED_PRICE), 6) + 0.0 as high from weekly_prices where ADJUSTED_PRICE > :least group by 1", least=1000.0)


@query(_with("fund", f"""select SECURITY_ID, {_DAY}, round(cogs, 4) as COGS_LTM from fund where SECURITY_ID in ('S2', 'S4') and "DATE" between date '1996-01-01' and date '1997-12-31'"""))
def fundamentals_ids(spark, sf):
    ids = spark.createDataFrame([("S2",), ("S4",), ("S2",)], "FACTSET_ID string")
    return _warehouse(spark, sf).fundamentals("1996-01-01", "1997-12-31", ids).select(ID, iso(DATE).alias(DATE), F.round("COGS_LTM", 4).alias("COGS_LTM"))


@query(f"with {_RATES} select strftime(d, '%Y-%m-%d') as DATE, ['EUR', 'GBP', 'JPY'][1 + cast(c as integer)] as CURRENCY, round(rate, 9) + 0.0 as EXCHANGE_RATE_TO_USD from rates where d between date '1996-01-01' and date '1996-06-30'")
def exchange_rates(spark, sf):
    """Renamed columns in a range of days; a warehouse without the table gives none."""
    rates = _house_with(spark, sf, exchange_rates=_values(spark, sf)["exchange_rates"]).exchange_rates("1996-01-01", "1996-06-30")
    every = rates.unionByName(_warehouse(spark, sf).exchange_rates("1996-01-01", "1996-06-30").select(*rates.columns))
    return every.select(iso(DATE).alias(DATE), "CURRENCY", (F.round(fx.RATE, 9) + 0.0).alias(fx.RATE))


@query(_with("prices", f"""select SECURITY_ID, {_DAY}, round(px * vol * 1.2::double, 4) as ENTERPRISE_VALUE from prices where SECURITY_ID in ('S2', 'S4') and "DATE" between date '1996-01-01' and date '1997-12-31'"""))
def enterprise_value_filter(spark, sf):
    house = _house_with(spark, sf, enterprise_value=_values(spark, sf)["enterprise_value"])
    return house.enterprise_value("1996-01-01", "1997-12-31", ["S2", "S4"]).select(ID, iso(DATE).alias(DATE), F.round("ENTERPRISE_VALUE", 4).alias("ENTERPRISE_VALUE"))


_BUNDLE = "between date '1998-01-05' - interval 400 days and date '1998-03-31'"


@query(_with("univ", f"""select 'prices' as name, count(*) as n, strftime(min("DATE"), '%Y-%m-%d') as first_date, strftime(max("DATE"), '%Y-%m-%d') as last_date from prices where "DATE" {_BUNDLE}
union all select 'returns', count(*), strftime(min("DATE"), '%Y-%m-%d'), strftime(max("DATE"), '%Y-%m-%d') from (select "DATE", px / nullif(lag(px) over (partition by SECURITY_ID order by "DATE"), 0) - 1 r from prices where "DATE" {_BUNDLE}) where r is not null
union all select 'fundamentals', count(*), strftime(min("DATE"), '%Y-%m-%d'), strftime(max("DATE"), '%Y-%m-%d') from prices where "DATE" between date '1998-01-05' and date '1998-03-31' union all select 'universe', count(*), null, null from univ"""))
def model_bundle(spark, sf):
    """What a model run of a quarter reads: 400 days of look-back for prices and returns."""
    out = []
    for name, df in _warehouse(spark, sf).model_tables("1998-01-05", "1998-03-31").items():
        day = F.col(DATE) if DATE in df.columns else F.lit(None).cast("date")
        out.append(df.agg(F.count(F.lit(1)).alias("n"), iso(F.min(day)).alias("first_date"), iso(F.max(day)).alias("last_date")).select(F.lit(name).alias("name"), "n", "first_date", "last_date"))
    return functools.reduce(DataFrame.unionByName, out)


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/quillon-{name}-{uuid.uuid4().hex}"


@query(_with("univ", f"""select 'prices' as name, SECURITY_ID, {_DAY}, round(px, 6) + 0.0 as value from prices where "DATE" {_BUNDLE} union all select 'fundamentals', SECURITY_ID, {_DAY}, round(s_ltm, 6) + 0.0 from fund where "DATE" between date '1998-01-05' and date '1998-03-31'
union all select 'universe', SECURITY_ID, SECTOR, null from univ"""))
def download(spark, sf):
    """Tables written by year and read again from the folder."""
    folder = _folder(spark, "download")
    _warehouse(spark, sf).download("1998-01-05", "1998-03-31", folder)
    with Warehouse(spark, folder=folder, config=type(CFG)(min_date="1990-01-01")) as house:
        prices, fundamentals = (shown(df, F.lit(k).alias("name"), ID, DATE, F.col(c).alias("value")) for k, df, c in (("prices", house.prices(), "ADJUSTED_PRICE"), ("fundamentals", house.fundamentals(), "SALES_LTM")))
        return prices.unionByName(fundamentals).unionByName(house.universe().select(F.lit("universe").alias("name"), ID, F.col("SECTOR").alias(DATE), F.lit(None).cast("double").alias("value")))


@query(_with("univ", f"""select SECURITY_ID, n_name as COUNTRY, SECTOR from univ join (select concat('S', s_suppkey) k, n_name from supplier join nation on s_nationkey = n_nationkey) on k = SECURITY_ID"""))
def universe_csv(spark, sf):
    """The universe from CSV, where the folder has no Parquet table of it."""
    folder = _folder(spark, "csv")
    _tables(spark, sf)["universe"].select(ID, "COUNTRY", "SECTOR").write.option("header", True).csv(f"{folder}/universe.csv")
    return Warehouse(spark, folder=folder).universe().select(ID, "COUNTRY", "SECTOR")


# Returns and rolling features


@query(_with("rets", f"select SECURITY_ID, {_DAY}, round(r, 6) + 0.0 as ONE_DAY_PCT from rets"))
def daily_returns(spark, sf):
    return shown(_tables(spark, sf)["returns"])


def _feed(spark, sf):
    t = _tables(spark, sf)
    return rolling.feed(t["returns"], t["prices"])


@query(_with("feed", f"select SECURITY_ID, {_DAY}, round(dv, 4) as DOLLAR_VOLUME from feed"))
def dollar_volume(spark, sf):
    return _feed(spark, sf).select(ID, iso(DATE).alias(DATE), F.round("DOLLAR_VOLUME", 4).alias("DOLLAR_VOLUME"))


def _rolling_query(name: str):
    def run(spark, sf):
        t = _tables(spark, sf)
        return shown(rolling.rolling_features(t["returns"], t["prices"], CFG).filter(F.col(name).isNotNull()), ID, DATE, name)

    run.__name__ = name.lower()
    query(_with("rolled", f"select SECURITY_ID, {_DAY}, {_rounded(name)} from rolled where {name} is not null"))(run)


for _name in crosssection.ROLLING:
    _rolling_query(_name)


DAILY = ModelConfig()


@query(_with("feed", ", " + _rolled(DAILY) + f" select SECURITY_ID, {_DAY}, {_rounded(*crosssection.ROLLING)} from rolled where MOMENTUM is not null or VOLATILITY is not null or LIQUIDITY is not null"))
def rolling_daily_settings(spark, sf):
    """The rolling features with the windows of daily production (252 and 21 returns, ten more in the buffer)."""
    t = _tables(spark, sf)
    some = F.coalesce(*crosssection.ROLLING).isNotNull()
    return shown(rolling.rolling_features(t["returns"], t["prices"], DAILY).filter(some))


@query(_with("rolled", f"select SECURITY_ID, {_DAY}, {_rounded(*crosssection.ROLLING)} from rolled"))
def rolling_stream(spark, sf):
    """The same features from a stream of observations, with a ring of values as each security's state."""
    folder = _folder(spark, "stream")
    _feed(spark, sf).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(f"{ID} string, {DATE} date, ONE_DAY_PCT double, DOLLAR_VOLUME double").parquet(f"{folder}/in")
    running = streaming.rolling_stream(stream, CFG).writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/out")
    running.awaitTermination()
    out = spark.read.schema(streaming.OUTPUT).parquet(f"{folder}/out")
    return shown(out.select(ID, DATE, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in crosssection.ROLLING]))


@query(f"select strftime(current_date - {2 * DAILY.volatility}, '%Y-%m-%d') as first_day, strftime(current_date, '%Y-%m-%d') as last_day")
def lookback_range(spark, sf):
    first, last = calendar.lookback(DAILY.volatility)
    return shown(spark.range(1).select(first.alias("first_day"), last.alias("last_day")))


def _panel(spark, sf):
    t = _tables(spark, sf)
    rows = ch.characteristics(t["fundamentals"], t["universe"], t["prices"])
    return rolling.as_of(rows, rolling.rolling_features(t["returns"], t["prices"], CFG), *crosssection.ROLLING)


@query(_with("panel", f"select SECURITY_ID, {_DAY}, {_rounded(*crosssection.ROLLING)} from panel"))
def rolling_asof(spark, sf):
    return shown(_panel(spark, sf), ID, DATE, *crosssection.ROLLING)


# Characteristics and cross-sections


def _char_query(name: str, columns: tuple[str, ...], step: str, make: Callable[[SparkSession, str], DataFrame]):
    def run(spark, sf):
        return shown(make(spark, sf), ID, DATE, *columns)

    run.__name__ = name
    query(_with(step, f"select SECURITY_ID, {_DAY}, {_rounded(*columns)} from {step}"))(run)


def _chars(spark, sf):
    t = _tables(spark, sf)
    return ch.characteristics(t["fundamentals"], t["universe"], t["prices"])


_char_query("value_chars", ch.VALUE, "chars", _chars)
_char_query("profitability_chars", ch.PROFITABILITY, "chars", _chars)
_char_query("growth_chars", ch.GROWTH, "chars", _chars)
_char_query("winsorize", crosssection.CHARACTERISTICS, "wins", lambda s, f: crosssection.winsorize(_panel(s, f), crosssection.CHARACTERISTICS, CFG.winsor))
_char_query("zscore", crosssection.CHARACTERISTICS, "zs", lambda s, f: crosssection.zscore(crosssection.winsorize(_panel(s, f), crosssection.CHARACTERISTICS, CFG.winsor), crosssection.CHARACTERISTICS))
_char_query("style_composites", crosssection.STYLES, "styles", lambda s, f: crosssection.style_exposures(_panel(s, f), CFG))


@query(_with("styles", """select strftime("DATE", '%Y-%m-%d') as DATE, count(VALUE) as n, round(avg(VALUE), 6) + 0.0 as mean, round(stddev_samp(VALUE), 6) + 0.0 as deviation from styles group by 1"""))
def zscore_invariants(spark, sf):
    df = crosssection.style_exposures(_panel(spark, sf), CFG)
    return shown(df.groupBy(DATE).agg(F.count("VALUE").alias("n"), F.avg("VALUE").alias("mean"), F.stddev_samp("VALUE").alias("deviation")))


def _exposures(spark, sf) -> Exposures:
    made = build_exposures(_tables(spark, sf), CFG)
    return Exposures(cut(made.wide, "exposures"), made.factors, made.model)


def _dummy_query(name: str, prefix: str):
    def run(spark, sf):
        made = build_exposures(_tables(spark, sf), CFG)
        return shown(crosssection.to_long(made.wide, [f for f in made.factors if f.startswith(prefix)], CFG.model), ID, DATE, "FACTOR_NAME", "EXPOSURE")

    run.__name__ = name
    query(_with("dum", f"select SECURITY_ID, {_DAY}, name as FACTOR_NAME, round(x, 6) + 0.0 as EXPOSURE from dum where kind = '{prefix[:-1]}'"))(run)


_dummy_query("sector_dummies", "SECTOR_")
_dummy_query("continent_dummies", "CONTINENT_")
_STYLE_ROWS = " union all ".join(f"""select SECURITY_ID, "DATE", '{s}' f, {s} x from styles where {s} is not null""" for s in crosssection.STYLES)
_LONG = f"""({_STYLE_ROWS} union all select SECURITY_ID, "DATE", name, x from dum)"""


@query(_with("dum", f"select '{CFG.model}' as MODEL, {_DAY}, SECURITY_ID, f as FACTOR_NAME, round(x, 6) + 0.0 as EXPOSURE from {_LONG}"))
def exposures_long(spark, sf):
    return shown(build_exposures(_tables(spark, sf), CFG).long())


@query(_with("styles", f"select SECURITY_ID, {_DAY}, {_rounded(*crosssection.STYLES)} from styles where " + " or ".join(f"{s} is not null" for s in crosssection.STYLES)))
def exposures_wide(spark, sf):
    long = build_exposures(_tables(spark, sf), CFG).long().filter(F.col("FACTOR_NAME").isin(*crosssection.STYLES))
    return shown(crosssection.to_wide(long, list(crosssection.STYLES)))


@query(_with("dum", f"""select distinct '{CFG.model}' as MODEL, case when f like 'SECTOR\\_%' escape '\\' then replace(substr(f, 8), '_', ' ') || ' Sector' when f like 'CONTINENT\\_%' escape '\\' then replace(substr(f, 11), '_', ' ') else f end as FACTOR_DISPLAY_NAME,
case when f like 'SECTOR\\_%' escape '\\' then 'Sector Factors' when f like 'CONTINENT\\_%' escape '\\' then 'Geographic Factors' else 'Style Factors' end as FACTOR_GROUP from {_LONG}"""))
def factor_names(spark, sf):
    return metadata.factor_names(build_exposures(_tables(spark, sf), CFG).long(), CFG)


@query(_with("dum", f"""select count(distinct "DATE") as n_dates, count(distinct SECURITY_ID) as n_securities, count(distinct f) as n_factors, strftime(min("DATE"), '%Y-%m-%d') as first_date, strftime(max("DATE"), '%Y-%m-%d') as last_date, count(*) as n_rows from {_LONG}"""))
def exposure_diagnostics(spark, sf):
    return shown(metadata.diagnostics(build_exposures(_tables(spark, sf), CFG).long()))


_QUARTERS = (("1998-01-01", "1998-03-31"), ("1998-04-01", "1998-06-30"))


@query(_with("dum", f"select {_DAY}, SECURITY_ID, f as FACTOR_NAME, round(x, 6) + 0.0 as EXPOSURE from {_LONG} where \"DATE\" between date '{_QUARTERS[0][0]}' and date '{_QUARTERS[1][1]}'"))
def exposures_by_quarter(spark, sf):
    """Two quarters, each built by itself after a warm-up on the rows before it, one after the other."""
    parts = [build_exposures(_tables(spark, sf), CFG, *q).long() for q in _QUARTERS]
    return shown(parts[0].unionByName(parts[1]).drop("MODEL"))


@query(_with("styles", f"""select SECURITY_ID, {_DAY}, round(r, 6) + 0.0 as ONE_DAY_PCT from rets where "DATE" in (select "DATE" from styles)"""))
def returns_on_exposure_dates(spark, sf):
    t = _tables(spark, sf)
    return shown(t["returns"].join(_panel(spark, sf).select(DATE).distinct(), DATE, "left_semi"), ID, DATE, "ONE_DAY_PCT")


# Factor returns, covariance, risk


def _fitted(spark, sf, factors: list[str]):
    """Two-factor inputs: wide exposures, returns, factor returns; the first two have several readers."""
    t = _tables(spark, sf)
    wide = cut(crosssection.style_exposures(_panel(spark, sf), CFG).select(ID, DATE, *factors), "styles")
    returns = cut(t["returns"], "returns")
    return wide, returns, cut(regression.factor_returns(wide, returns, factors, CFG), "factor-returns")


@query(_with("fit1", f"""select '{CFG.model}' as MODEL, {_DAY}, f as FACTOR_NAME, round(x, 6) + 0.0 as RETURN from (select "DATE", 'INTERCEPT' f, a x from fit1 union all select "DATE", 'VALUE', b from fit1)"""))
def factor_returns_1f(spark, sf):
    return shown(_fitted(spark, sf, ["VALUE"])[2])


@query(_with("fr", f"""select '{CFG.model}' as MODEL, {_DAY}, f as FACTOR_NAME, round(x, 6) + 0.0 as RETURN from fr"""))
def factor_returns_2f(spark, sf):
    return shown(_fitted(spark, sf, ["VALUE", "GROWTH"])[2])


@query()
def factor_returns_full(spark, sf):
    made = _exposures(spark, sf)
    return shown(regression.factor_returns(made.wide, _tables(spark, sf)["returns"], live_factors(made), CFG))


_NAMES = "(select unnest([" + ", ".join(f"'{s}'" for s in crosssection.STYLES) + "]) f union select distinct name from dum)"
_WHOLE = " and ".join(f"{s} is not null" for s in crosssection.STYLES)


@query(_with("dum", f"""select {_DAY}, f as FACTOR_NAME, 0.0::double as dot from (select "DATE" from styles join rets using (SECURITY_ID, "DATE") where {_WHOLE} group by 1 having count(*) >= (select count(*) from {_NAMES}) + 2) join {_NAMES} on true"""))
def ols_orthogonality(spark, sf):
    """Each factor's exposures times what all factors leave over, by date: zero throughout."""
    made = _exposures(spark, sf)
    t = _tables(spark, sf)
    live = live_factors(made)
    factors = cut(regression.factor_returns(made.wide, t["returns"], live, CFG), "factor-returns")
    whole = made.wide.dropna(subset=live)
    long = crosssection.to_long(whole, live, CFG.model)
    left = regression.specific_returns(whole, t["returns"], factors, type(CFG)(subtract_intercept=True))
    return shown(long.join(left, [DATE, ID]).groupBy(DATE, "FACTOR_NAME").agg(F.sum(F.col("EXPOSURE") * F.col("SPECIFIC_RETURN")).alias("dot")))


@query(_with("dum", f"""select {_DAY}, 0.0::double as sectors, 0.0::double as places, 0.0::double as absent from (select "DATE" from styles join rets using (SECURITY_ID, "DATE") where {_WHOLE} group by 1 having count(*) >= (select count(*) from {_NAMES}) + 2)"""))
def ols_minimum_norm(spark, sf):
    """Of all least-squares solutions, which ``ols_orthogonality`` proves, the one of least norm: dummies of a group sum to a constant
    by construction, so its returns sum to zero in each group, and a value that is absent on a date has none."""
    made = _exposures(spark, sf)
    live = live_factors(made)
    returns = _tables(spark, sf)["returns"]
    factors = regression.factor_returns(made.wide, returns, live, CFG)
    rows = made.wide.dropna(subset=live).join(returns, [ID, DATE])
    absent = [f for f in live if f.startswith(("SECTOR_", "CONTINENT_"))]
    there = rows.groupBy(DATE).agg(*[(F.max(F.abs(f)) == 0).alias(f) for f in absent])
    there = there.select(DATE, F.filter(F.array(*[F.when(F.col(f), F.lit(f)) for f in absent]), lambda x: x.isNotNull()).alias("gone"))
    of = lambda prefix: F.sum(F.when(F.col("FACTOR_NAME").startswith(prefix), F.col("RETURN")).otherwise(0.0))
    none = F.max(F.when(F.array_contains("gone", F.col("FACTOR_NAME")), F.abs("RETURN")).otherwise(0.0))
    return shown(factors.join(there, DATE).groupBy(DATE).agg(of("SECTOR_").alias("sectors"), of("CONTINENT_").alias("places"), none.alias("absent")))


@query(_with("dum", f"""select {_DAY}, count(*) as n, (select count(*) from {_NAMES}) + 1 as n_coefficients from styles join rets using (SECURITY_ID, "DATE") where {_WHOLE} group by 1, "DATE" having count(*) >= (select count(*) from {_NAMES}) + 2"""))
def complete_cases(spark, sf):
    """Dates with a regression on all factors: their complete rows, and coefficients, as many on every date."""
    made = _exposures(spark, sf)
    live, returns = live_factors(made), _tables(spark, sf)["returns"]
    factors = regression.factor_returns(made.wide, returns, live, CFG).groupBy(DATE).agg(F.count(F.lit(1)).alias("n_coefficients"))
    rows = made.wide.dropna(subset=live).join(returns, [ID, DATE]).groupBy(DATE).agg(F.count(F.lit(1)).alias("n"))
    return shown(rows.join(factors, DATE), DATE, "n", "n_coefficients")


def _whole_model(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs on all factors: wide exposures, returns, factor returns."""
    made = _exposures(spark, sf)
    returns = cut(_tables(spark, sf)["returns"], "returns")
    return made.wide, returns, cut(regression.factor_returns(made.wide, returns, live_factors(made), CFG), "factor-returns")


@query()
def specific_returns_full(spark, sf):
    return shown(regression.specific_returns(*_whole_model(spark, sf), CFG))


@query()
def factor_covariance_full(spark, sf):
    return shown(covariance.factor_covariance(_whole_model(spark, sf)[2], CFG))


@query()
def specific_risk_full(spark, sf):
    return shown(covariance.specific_risk(*_whole_model(spark, sf), CFG))


@query(_with("dum", f"""select file, n, 0 as n_unordered from (select count(*) n from {_LONG} where "DATE" between date '{_QUARTERS[0][0]}' and date '{_QUARTERS[0][1]}') join (select unnest(['exposures.csv', 'exposures.parquet']) as file) on true"""))
def sorted_outputs(spark, sf):
    """A run's exposures, written in both formats and read again: rows, and those that aren't in order of date, security and factor
    within their file or between files."""
    folder = _folder(spark, "outputs")
    write_outputs({"exposures": build_exposures(_tables(spark, sf), CFG, *_QUARTERS[0]).long().withColumn(DATE, iso(DATE))}, folder)
    parts = []
    for kind in ("csv", "parquet"):
        df = spark.read.schema(OUTPUTS["exposures"]).options(header=True).format(kind).load(f"{folder}/exposures.{kind}")
        key = F.struct(DATE, ID, "FACTOR_NAME").alias("key")
        placed = df.select(key, F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"))
        w = Window.partitionBy("file").orderBy("place")
        inside = placed.withColumn("before", F.lag("key").over(w)).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("before") > F.col("key")).cast("long")).alias("bad"), F.min("key").alias("low"), F.max("key").alias("high"))
        # A row for each file: the one window without a key sees no more.
        between = inside.withColumn("previous", F.lag("high").over(Window.orderBy("file")))
        parts.append(between.agg(F.sum("n").alias("n"), F.sum(F.coalesce("bad", F.lit(0)) + F.coalesce((F.col("previous") > F.col("low")).cast("long"), F.lit(0))).alias("n_unordered")).select(F.lit(f"exposures.{kind}").alias("file"), "n", "n_unordered"))
    return parts[0].unionByName(parts[1])


@query(_with("spec", f"select '{CFG.model}' as MODEL, {_DAY}, SECURITY_ID, round(e, 6) + 0.0 as SPECIFIC_RETURN from spec"))
def specific_returns(spark, sf):
    return shown(regression.specific_returns(*_fitted(spark, sf, ["VALUE", "GROWTH"]), CFG))


@query(_with("idx", f"""select '{CFG.model}' as MODEL, {_DAY}, f as FACTOR_NAME_1, g as FACTOR_NAME_2, round(c, 8) + 0.0 as COVARIANCE from (select a."DATE", idx, a.f, b.f g, covar_samp(a.x, b.x) over (partition by a.f, b.f order by idx rows between {CFG.covariance - 1} preceding and current row) c
from fr a join fr b on a."DATE" = b."DATE" and a.f <= b.f join idx on idx."DATE" = a."DATE") where idx >= {CFG.covariance_least - 1}"""))
def factor_covariance(spark, sf):
    cov = covariance.factor_covariance(_fitted(spark, sf, ["VALUE", "GROWTH"])[2], CFG)
    return cov.select("MODEL", iso(DATE).alias(DATE), "FACTOR_NAME_1", "FACTOR_NAME_2", (F.round("COVARIANCE", 8) + 0.0).alias("COVARIANCE"))


@query(_with("tv", f"select SECURITY_ID, {_DAY}, round(v, 6) + 0.0 as TOTAL_VAR from tv"))
def total_variance(spark, sf):
    return shown(covariance.total_variance(*_fitted(spark, sf, ["VALUE", "GROWTH"]), CFG))


@query(_with("fv", f"select SECURITY_ID, {_DAY}, round(v, 6) + 0.0 as FACTOR_VAR from fv"))
def factor_variance(spark, sf):
    wide, _, factors = _fitted(spark, sf, ["VALUE", "GROWTH"])
    return shown(covariance.factor_variance(wide, factors, CFG))


_SPECIFIC = f"greatest(t - case when greatest(coalesce(f, 0), 0) >= t then {CFG.risk_cap}::double * t else greatest(coalesce(f, 0), 0) end, {CFG.risk_floor}::double * t, {CFG.risk_epsilon}::double)"


@query(_with("fv", f"""select '{CFG.model}' as MODEL, {_DAY}, SECURITY_ID, round({_SPECIFIC}, 6) + 0.0 as SPECIFIC_VAR from (select tv.SECURITY_ID, tv."DATE", tv.v t, fv.v f from tv left join fv on fv.SECURITY_ID = tv.SECURITY_ID and fv."DATE" = tv."DATE")"""))
def specific_risk(spark, sf):
    return shown(covariance.specific_risk(*_fitted(spark, sf, ["VALUE", "GROWTH"]), CFG))


_CASES = ((1, 1.0, 0.5), (2, 1.0, 0.999), (3, 1.0, 1.0), (4, 1.0, 2.0), (5, 1e-7, 0.0), (6, 1e-9, 5e-10), (7, 1.0, None), (8, 1.0, -0.5))


@query(f"select k, {_SPECIFIC} as SPECIFIC_VAR from (values " + ", ".join(f"({k}::bigint, {t}::double, {'null' if f is None else f}::double)" for k, t, f in _CASES) + ") v(k, t, f)")
def specific_risk_floor_cases(spark, sf):
    df = spark.createDataFrame(list(_CASES), "k long, t double, f double")
    return df.select("k", covariance.specific_variance(F.col("t"), F.col("f"), CFG).alias("SPECIFIC_VAR"))
