"""Run settings. Everything a job needs to know that is not in the data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# The eleven model inputs, in matrix order.
FEATURE_COLS = (
    "return_1d", "ma_5", "ma_20", "ma_50", "volatility_20",
    "rsi_14", "volume_zscore", "fedfunds", "cpiaucsl", "vix", "t10y2y",
)

# Macro series id -> (feature column, description).
MACRO_SERIES = {
    "FEDFUNDS": ("fedfunds", "Federal Funds Rate"),
    "CPIAUCSL": ("cpiaucsl", "CPI - Inflation"),
    "VIXCLS": ("vix", "CBOE Volatility Index (VIX)"),
    "T10Y2Y": ("t10y2y", "10Y-2Y Treasury Yield Spread"),
}

# The audit table's names of the two sources.
PRICE_SOURCE = "yfinance"
MACRO_SOURCE = "fred"

FEATURE_VERSION = "v1"


def parse_list(text: str) -> tuple[str, ...]:
    """Split a comma-separated setting."""
    return tuple(part for part in text.split(",") if part)


@dataclass(frozen=True)
class Settings:
    as_of: date                       # stands for today
    cutoff: date                      # first day of the test set
    tickers: tuple[str, ...]          # expected keys
    lookback_years: int = 5           # first load reaches 365 days x this back
    lag_days: int = 1                 # macro rows must be this many days older than the bar
    drift_days: int = 30              # current window of the drift comparison
    recent_rows: int = 30             # rows per key in the anomaly listing
    load_stale_days: int = 5          # quality check
    serving_stale_days: int = 3       # freshness flag on predictions
    contamination: float = 0.05
    trees: int = 100
    tree_rows: int = 256
    seed: int = 42
