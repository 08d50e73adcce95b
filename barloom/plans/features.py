"""The feature table: rolling columns, as-of macro values, RSI and the next-day label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import series as S
from ..operators.asof import asof_calendar
from ..operators.chunked import by_chunks
from ..settings import FEATURE_COLS, FEATURE_VERSION, MACRO_SERIES

MACRO_COLUMNS = {series_id: column for series_id, (column, _) in MACRO_SERIES.items()}


def add_windows(bars: DataFrame, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Return, moving averages, volatility, volume z-score and label.

    One exchange and one sort by (keys, date) serve every column. (ticker, date) is the
    loaded table's key, so a window group holds at most one row per calendar day.
    """
    w = S.ordered(*keys)
    rolled = (
        bars.withColumn("_previous", S.previous("adj_close", w))
        .withColumn("return_1d", S.change_from("_previous", "adj_close"))
        .withColumns({"_place": S.place(w), "_next": S.following("adj_close", w)})
        .withColumns({
            "ma_5": S.rolling_mean("adj_close", w, 5, "_place"),
            "ma_20": S.rolling_mean("adj_close", w, 20, "_place"),
            "ma_50": S.rolling_mean("adj_close", w, 50, "_place"),
            "volatility_20": S.rolling_stddev("return_1d", w, 20),
            "volume_zscore": S.rolling_zscore("volume", w, 20),
            "target": S.is_higher("_next", "adj_close"),
        })
    )
    return rolled.drop("_previous", "_place", "_next")


def _assemble(bars: DataFrame, macro: DataFrame, lag_days: int, keys: Sequence[str]) -> DataFrame:
    # Windows see every bar; the as-of join then drops bars older than the macro data;
    # RSI runs on the bars that are left. The order of the three steps is part of the result.
    joined = asof_calendar(add_windows(bars, keys), macro, MACRO_COLUMNS, lag_days)
    return S.with_rsi(joined, "return_1d", S.ordered(*keys))


def build_features(bars: DataFrame, macro: DataFrame, lag_days: int = 1,
                   chunk_rows: int | None = None) -> DataFrame:
    """One row per bar that has all four macro values; no run timestamp.

    `chunk_rows` splits long histories into chunks of that many rows, for tables with
    fewer tickers than cores. The result is the same.
    """
    source = bars.select("ticker", "date", "adj_close", "volume")
    if chunk_rows is None:
        wide = _assemble(source, macro, lag_days, ("ticker",))
    else:
        wide = by_chunks(source, "ticker", "date", chunk_rows, lookback=64, lookahead=1,
                         transform=lambda df, keys: _assemble(df, macro, lag_days, keys))
    return wide.select("ticker", "date", *FEATURE_COLS, "target",
                       F.lit(FEATURE_VERSION).alias("feature_version"))


def rsi_update(features: DataFrame, rsi: DataFrame) -> DataFrame:
    """Set rsi_14 from a (ticker, date, rsi_14) table; rows it lacks keep NULL."""
    return (features.drop("rsi_14").join(rsi, ["ticker", "date"], "left")
            .select(*features.columns))


def feature_summary(features: DataFrame) -> DataFrame:
    """Per ticker: rows, warm-up nulls and the covered dates."""
    return (
        features.groupBy("ticker")
        .agg(F.count("*").alias("row_count"),
             F.count_if(F.col("rsi_14").isNull()).alias("rsi_nulls"),
             F.count_if(F.col("ma_50").isNull()).alias("ma_50_nulls"),
             F.min("date").alias("min_date"), F.max("date").alias("max_date"))
        .orderBy("ticker")
    )
