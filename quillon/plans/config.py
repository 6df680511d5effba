"""Parameters of a model run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ModelConfig:
    """Every window, bound and switch; the defaults are the daily production settings."""

    model: str = "EQUITY_MODEL"
    momentum: int = 252
    momentum_skip: int = 21
    momentum_slack: int = 10
    volatility: int = 60
    liquidity: int = 20
    winsor: tuple[float, float] = (0.01, 0.99)
    intercept: bool = True
    subtract_intercept: bool = False
    cutoff: float = 1e-10
    covariance: int = 60
    covariance_least: int = 30
    risk: int = 60
    risk_floor: float = 0.01
    risk_cap: float = 0.95
    risk_epsilon: float = 1e-8
    lookback_days: int = 400
    min_date: str = "2015-01-01"
    max_stocks: int | None = 500
    sample_seed: int = 42
    neutralize: bool = False

    def __post_init__(self) -> None:
        if self.neutralize:
            raise NotImplementedError("exposures are never neutralised")


#: Weekly series of the sample tables, too short for a year of daily returns.
WEEKLY = ModelConfig(momentum=52, momentum_skip=4)
