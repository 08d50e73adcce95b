"""Bars and macro series derived from the order and event tables.

Both adapters pre-aggregate before anything is shuffled by a coarse key: a ticker or a
series then holds at most one row per calendar day, however many source rows it has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None) -> DataFrame:
    return table(spark, sf_dir, "lineitem") if lines is None else lines


def bars(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None,
         start: date | None = None, end: date | None = None) -> DataFrame:
    """Daily bars, one ticker per order priority; the price is the day's last order.

    Lineitem is reduced to one row per order first, so the order join is one-to-one and
    the join reuses the aggregate's partitioning. Bounds (start <= date < end) are put on the
    order's own timestamp, where the file scan can use them; a date made of it cannot be
    pushed down. Spark adds its runtime Bloom filter of the kept orders to the scan of
    lineitem when that is large.
    """
    quantity = (
        _lines(spark, sf_dir, lines)
        .groupBy("l_orderkey").agg(F.expr("CAST(sum(l_quantity) AS BIGINT) AS quantity"))
    )
    orders = table(spark, sf_dir, "orders")
    moment = orders.schema["o_orderdate"].dataType
    if start is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(str(start)).cast(moment))
    if end is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(str(end)).cast(moment))
    orders = orders.selectExpr(
        "o_orderkey", "o_orderpriority AS ticker", "to_date(o_orderdate) AS date", "o_totalprice")
    return (
        orders.join(quantity, F.expr("o_orderkey = l_orderkey"))
        .groupBy("ticker", "date")
        .agg(
            F.expr("min_by(o_totalprice, o_orderkey) AS open"),
            F.expr("max(o_totalprice) AS high"),
            F.expr("min(o_totalprice) AS low"),
            F.expr("max_by(o_totalprice, o_orderkey) AS close"),
            F.expr("max_by(o_totalprice, o_orderkey) AS adj_close"),
            F.expr("sum(quantity) AS volume"),
        )
    )


def bars_wide(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Daily bars with one ticker per supplier: many keys."""
    return (
        _lines(spark, sf_dir, lines)
        .groupBy(F.col("l_suppkey").cast("string").alias("ticker"),
                 F.to_date("l_shipdate").alias("date"))
        .agg(F.max("l_extendedprice").alias("adj_close"),
             F.sum(F.col("l_quantity").cast("bigint")).alias("volume"))
    )


def macro(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Two monthly and two daily series, from one scan of lineitem.

    The first aggregate leaves at most one row per flag pair and day; the four series
    are cut from that, not from four scans.
    """
    daily = (
        _lines(spark, sf_dir, lines)
        .groupBy("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("day"))
        .agg(F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"))
    )
    return (
        daily.selectExpr("""
            inline(array(
                named_struct(
                    'series_id', CASE l_returnflag WHEN 'A' THEN 'FEDFUNDS'
                                 WHEN 'N' THEN 'CPIAUCSL' WHEN 'R' THEN 'VIXCLS' END,
                    'date', CASE WHEN l_returnflag = 'R' THEN day ELSE trunc(day, 'month') END,
                    'value', high),
                named_struct('series_id', CASE WHEN l_linestatus = 'F' THEN 'T10Y2Y' END,
                             'date', day, 'value', low)))""")
        .where("series_id IS NOT NULL")
        .groupBy("series_id", "date")
        .agg(F.expr("CASE WHEN series_id = 'T10Y2Y' THEN min(value) ELSE max(value) END AS value"))
    )


def bars_dirty(bars_df: DataFrame) -> DataFrame:
    """Bars with planted nulls: price on 13 April, volume on 14 April."""
    day, april = F.dayofmonth("date"), F.month("date") == 4
    return bars_df.withColumns({
        "adj_close": F.when(april & (day == 13), None).otherwise(F.col("adj_close")),
        "volume": F.when(april & (day == 14), None).otherwise(F.col("volume")),
    })


def download_shape(bars_df: DataFrame, key_value_in_name: str = "X") -> DataFrame:
    """Bars as a price download names them: `Adj Close|X`, `Open|X`, ... and `Date`."""
    names = {"open": "Open", "high": "High", "low": "Low", "close": "Close",
             "adj_close": "Adj Close", "volume": "Volume"}
    return bars_df.select(
        F.col("ticker").alias("Ticker"),
        F.col("date").cast("timestamp").alias("Date"),
        *(F.col(c).alias(f"{name}|{key_value_in_name}") for c, name in names.items()),
    )
