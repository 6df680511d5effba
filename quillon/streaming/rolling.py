"""Rolling features over a stream of observations, with a bounded state for each security.

State is what the longest window needs: the last returns and the last positive dollar volumes. Rows of a security must
arrive in date order across micro-batches; within one they are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillon.plans.config import ModelConfig
from quillon.sources.schemas import DATE, ID

OUTPUT = f"{ID} string, {DATE} date, MOMENTUM double, VOLATILITY double, LIQUIDITY double"
STATE = "returns array<double>, volumes array<double>, seen long, liquidity double"


def step(returns: list[float], volumes: list[float], seen: int, liquidity: float | None, r: float, dv: float | None, cfg: ModelConfig) -> tuple:
    """One observation: the new state, and the three features."""
    returns = [*returns, r][-(cfg.momentum + cfg.momentum_skip + cfg.momentum_slack) :]
    seen += 1
    if dv is not None and dv > 0:
        volumes = [*volumes, dv][-cfg.liquidity :]
        if len(volumes) == cfg.liquidity:
            liquidity = float(np.log(np.mean(volumes)))
    growth = 1 + np.array(returns)
    momentum = float(np.prod(growth[: -cfg.momentum_skip]) - np.prod(growth[-cfg.momentum_skip :])) if seen >= cfg.momentum + cfg.momentum_skip else None
    volatility = float(np.std(returns[-cfg.volatility :], ddof=1)) if seen >= cfg.volatility else None
    return returns, volumes, seen, liquidity, momentum, volatility


def rolling_stream(observations: DataFrame, cfg: ModelConfig) -> DataFrame:
    """``SECURITY_ID, DATE, MOMENTUM, VOLATILITY, LIQUIDITY`` of a stream with ONE_DAY_PCT and DOLLAR_VOLUME."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        returns, volumes, seen, liquidity = state.get if state.exists else ([], [], 0, None)
        returns, volumes, rows = list(returns), list(volumes), []
        for row in pd.concat(list(frames)).sort_values(DATE, kind="stable").itertuples():
            dv = None if pd.isna(row.DOLLAR_VOLUME) else row.DOLLAR_VOLUME
            returns, volumes, seen, liquidity, momentum, volatility = step(returns, volumes, seen, liquidity, row.ONE_DAY_PCT, dv, cfg)
            rows.append((key[0], getattr(row, DATE), momentum, volatility, liquidity))
        state.update((returns, volumes, seen, liquidity))
        out = pd.DataFrame(rows, columns=[ID, DATE, "MOMENTUM", "VOLATILITY", "LIQUIDITY"])
        yield out.astype({c: float for c in ("MOMENTUM", "VOLATILITY", "LIQUIDITY")})

    rows = observations.select(ID, DATE, "ONE_DAY_PCT", "DOLLAR_VOLUME").filter("ONE_DAY_PCT is not null")
    return rows.groupBy(ID).applyInPandasWithState(run, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
