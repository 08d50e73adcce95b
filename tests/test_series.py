"""Window expressions on small hand-made series."""

import re
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import series as S
from barloom.operators.chunked import by_chunks
from barloom.plans import features as P
from barloom.settings import MACRO_SERIES

START = date(2020, 1, 1)


def bars(spark, prices, volumes=None, ticker="A", start=START):
    volumes = volumes or [100 + i % 7 for i in range(len(prices))]
    data = [(ticker, start + timedelta(days=i), p, v)
            for i, (p, v) in enumerate(zip(prices, volumes))]
    return spark.createDataFrame(data, "ticker string, date date, adj_close double, volume long")


def flat_macro(spark, since=date(2010, 1, 1)):
    data = [(s, since, float(i)) for i, s in enumerate(MACRO_SERIES)]
    return spark.createDataFrame(data, "series_id string, date date, value double")


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def random_prices(n, seed=1):
    return [float(p) for p in 100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, .02, n)))]


def test_constant_volume_has_no_zscore(spark):
    out = P.add_windows(bars(spark, random_prices(25), [500] * 25))
    assert column(out, "volume_zscore") == [None] * 25


def test_null_volume_empties_the_frames_it_is_in(spark):
    volumes = [100 + i % 7 for i in range(45)]
    volumes[10] = None
    z = column(P.add_windows(bars(spark, random_prices(45), volumes)), "volume_zscore")
    assert [i for i, v in enumerate(z) if v is not None] == list(range(30, 45))


def test_target_of_equal_prices_is_zero_and_last_is_null(spark):
    out = P.add_windows(bars(spark, [1.0, 1.0, 2.0, 1.5]))
    assert column(out, "target") == [0, 1, 0, None]


def test_one_row_series(spark):
    row = P.add_windows(bars(spark, [3.0])).first()
    assert row.return_1d is None and row.ma_5 is None and row.target is None


def test_zero_price_gives_no_return(spark):
    assert column(P.add_windows(bars(spark, [1.0, 0.0, 2.0])), "return_1d") == [None, -1.0, None]


def test_series_do_not_mix(spark):
    both = bars(spark, random_prices(30)).union(bars(spark, random_prices(30, 2), ticker="B"))
    alone = column(P.add_windows(bars(spark, random_prices(30, 2), ticker="B")), "ma_5")
    assert column(P.add_windows(both).where("ticker = 'B'"), "ma_5") == alone


def test_rsi_without_losses_is_null(spark):
    df = spark.createDataFrame([("A", START + timedelta(days=i), float(i * i)) for i in range(20)],
                               "ticker string, date date, return_1d double")
    assert column(S.with_rsi(df, "return_1d", S.ordered("ticker")), "rsi_14") == [None] * 20


def test_rsi_follows_its_definition(spark):
    """Row by row from the definition: changes of the return, means of the last 14."""
    prices = random_prices(80)
    out = S.with_rsi(P.add_windows(bars(spark, prices)), "return_1d", S.ordered("ticker"))
    got = column(out, "rsi_14")
    returns = [None] + [b / a - 1 for a, b in zip(prices, prices[1:])]
    assert got[:15] == [None] * 15
    for day in range(15, len(prices)):
        up = down = 0.0
        for k in range(day - 13, day + 1):
            change = returns[k] - returns[k - 1]
            if change > 0:
                up += change / 14
            else:
                down -= change / 14
        assert got[day] == pytest.approx(100 * up / (up + down), rel=1e-9)


@pytest.mark.parametrize("dropped", [0, 1, 7, 60])
def test_warm_up_nulls(spark, dropped):
    """The first `dropped` bars precede the macro data."""
    macro = flat_macro(spark, START + timedelta(days=dropped - 1))
    built = P.build_features(bars(spark, random_prices(120)), macro)
    nulls = built.agg(F.count("*"), *(F.count_if(F.col(c).isNull()) for c in (
        "ma_5", "ma_20", "ma_50", "volatility_20", "volume_zscore", "rsi_14"))).first()
    k = dropped
    assert tuple(nulls) == (120 - k, max(0, 4 - k), max(0, 19 - k), max(0, 49 - k),
                            max(0, 20 - k), max(0, 19 - k), 15 if k == 0 else 14)


def test_later_rows_do_not_change_earlier_ones(spark):
    prices = random_prices(90)
    drop = ["target"]
    short = P.build_features(bars(spark, prices[:70]), flat_macro(spark)).drop(*drop)
    whole = P.build_features(bars(spark, prices), flat_macro(spark)).drop(*drop)
    last = START + timedelta(days=69)
    assert whole.where(F.col("date") <= F.lit(last)).exceptAll(short).count() == 0
    assert short.count() == 70


def test_chunks_equal_the_whole(spark):
    """Three series of different length, one with long gaps, in chunks of 70 rows."""
    long = bars(spark, random_prices(1000))
    sparse = spark.createDataFrame(
        [("B", START + timedelta(days=40 * i), float(p), 100 + i % 5)
         for i, p in enumerate(random_prices(150, 3))],
        "ticker string, date date, adj_close double, volume long")
    source = long.union(sparse).union(bars(spark, random_prices(20, 5), ticker="C"))
    macro = flat_macro(spark, START + timedelta(days=100))
    plain = P.build_features(source, macro)
    chunked = P.build_features(source, macro, chunk_rows=70)
    assert chunked.count() == plain.count()
    assert chunked.exceptAll(plain).count() == 0


def test_windows_are_partitioned_by_chunk(spark):
    built = P.build_features(bars(spark, random_prices(200)), flat_macro(spark), chunk_rows=100)
    text = built._jdf.queryExecution().executedPlan().toString()
    # All windows after the cut run on this one exchange; the only one by ticker alone
    # carries the row counts.
    assert len(re.findall(r"hashpartitioning\(ticker#\d+, _chunk#\d+", text)) == 1
    assert len(re.findall(r"hashpartitioning\(ticker#\d+, \d+\)", text)) == 1


def test_chunk_must_exceed_its_overlap(spark):
    with pytest.raises(ValueError):
        by_chunks(bars(spark, [1.0]), "ticker", "date", 64, 64, 1, lambda df, keys: df)


def test_summary_and_update(spark):
    built = P.build_features(bars(spark, random_prices(60)), flat_macro(spark))
    summary = P.feature_summary(built).first()
    assert (summary.row_count, summary.rsi_nulls, summary.ma_50_nulls) == (60, 15, 49)
    update = spark.createDataFrame([("A", START, 7.0)], "ticker string, date date, rsi_14 double")
    out = P.rsi_update(built, update)
    assert out.columns == built.columns
    assert out.where("rsi_14 IS NOT NULL").select("rsi_14").collect() == [(7.0,)]
