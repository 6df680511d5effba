"""Every query with SQL gives the SQL's rows."""

import math

import duckdb
import pytest
from tests.conftest import SF_SMALL

from quillon.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return con


def _plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    columns = sorted(got.columns)
    rows = sorted((tuple(_plain(r[c]) for c in columns) for r in got.collect()), key=str)
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(want.columns) == columns
        assert rows == sorted((tuple(_plain(v) for v in r) for r in want[columns].astype(object).itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", ["fx_convert_dated", "fx_convert_latest"])
def test_fx_converts_every_order(spark, name):
    keys = [r[0] for r in QUERIES[name](spark, SF_SMALL).select("o_orderkey").collect()]
    assert sorted(keys) == sorted(r[0] for r in spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey").collect())


def test_whole_model(spark, tmp_path):
    from quillon.plans.config import WEEKLY
    from quillon.plans.model import build_model
    from quillon.sources.schemas import OUTPUTS
    from quillon.sources.sinks import write_outputs
    from quillon.sources.weekly import weekly_tables

    out = build_model(weekly_tables(spark, SF_SMALL), WEEKLY, "1998-01-01", "1998-12-31")
    assert set(out) == set(OUTPUTS)
    write_outputs({k: out[k] for k in ("exposures", "factor_names", "specific_risk")}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/exposures.parquet").count() > 0
    assert spark.read.csv(f"{tmp_path}/factor_model_factor_names.csv", header=True).columns == ["MODEL", "FACTOR_DISPLAY_NAME", "FACTOR_GROUP"]
    assert spark.read.parquet(f"{tmp_path}/variance.parquet").columns == ["MODEL", "DATE", "SECURITY_ID", "SPECIFIC_VAR"]
