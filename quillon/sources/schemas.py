"""Schemas of the input and output tables, and the names that columns may go by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID, DATE = "SECURITY_ID", "DATE"
#: Other names of the two key columns.
SYNONYMS = {ID: ("SECURITY_ID", "FACTSET_ID", "FSYM_ID"), DATE: ("DATE", "P_DATE")}
FUNDAMENTALS = ("SALES_LTM", "SALES_NTM", "COGS_LTM", "COGS_NTM", "EBITDA_LTM", "EBITDA_NTM", "EPS_LTM", "EPS_NTM")
_DOUBLES = lambda *names: ", ".join(f"{n} double" for n in names)
INPUTS = {
    "prices": f"{ID} string, {DATE} date, {_DOUBLES('SPLIT_FACTOR', 'SPECIAL_DIVS_FACTOR', 'UNADJUSTED_PRICE', 'ADJUSTED_PRICE', 'ADJUSTED_VOLUME', 'ADJUSTED_PRICE_DAY_HIGH', 'ADJUSTED_PRICE_DAY_LOW')}, CURRENCY string, {_DOUBLES('P_DIVS_PD', 'P_SPLIT_FACTOR')}, IS_HOLIDAY boolean",
    "returns": f"{ID} string, {DATE} date, ONE_DAY_PCT double",
    "fundamentals": f"{ID} string, {DATE} date, {_DOUBLES(*FUNDAMENTALS)}",
    "universe": f"{ID} string, COUNTRY string, SECTOR string",
    "exchange_rates": f"{DATE} date, CURRENCY string, EXCHANGE_RATE_TO_USD double",
    "market_value": f"{ID} string, {DATE} date, CURRENCY string, MARKETCAP double",
    "enterprise_value": f"{ID} string, {DATE} date, ENTERPRISE_VALUE double, EV_COMPONENTS_DATE date",
}
OUTPUTS = {
    "exposures": f"MODEL string, {DATE} string, {ID} string, FACTOR_NAME string, EXPOSURE double",
    "factor_returns": f"MODEL string, {DATE} string, FACTOR_NAME string, RETURN double",
    "specific_returns": f"MODEL string, {DATE} string, {ID} string, SPECIFIC_RETURN double",
    "specific_risk": f"MODEL string, {DATE} string, {ID} string, SPECIFIC_VAR double",
    "factor_covariance": f"MODEL string, {DATE} string, FACTOR_NAME_1 string, FACTOR_NAME_2 string, COVARIANCE double",
    "factor_names": "MODEL string, FACTOR_DISPLAY_NAME string, FACTOR_GROUP string",
}


def canonical(df: DataFrame, dated: bool = True) -> DataFrame:
    """``df`` with its key columns under their canonical names, DATE as a date, and NaN as null in double columns."""
    for name in (ID, DATE) if dated else (ID,):
        found = next((c for s in SYNONYMS[name] for c in df.columns if c.upper() == s), None)
        if found is None:
            raise ValueError(f"no {name} column among {df.columns}")
        if found != name:
            df = df.withColumnRenamed(found, name)
    changes = {c: F.when(~F.isnan(c), F.col(c)) for c, kind in df.dtypes if kind in ("double", "float")}
    if dated and dict(df.dtypes)[DATE] != "date":
        changes[DATE] = F.to_date(DATE)
    return df.withColumns(changes) if changes else df
