"""Checks on loaded bars. Each returns one row per finding; none stops the others."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(bars: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tickers without a single row. The bars are counted per ticker first."""
    counts = bars.groupBy("ticker").agg(F.count("*").alias("row_count"))
    return (
        expected.join(counts, "ticker", "left")
        .select("ticker", F.coalesce("row_count", F.lit(0)).alias("row_count"))
        .where(F.col("row_count") == 0)
    )


def null_values(bars: DataFrame, column: str = "adj_close") -> DataFrame:
    """Tickers with NULLs in `column` and how many. Meant for a batch before its load."""
    return (
        bars.where(F.col(column).isNull())
        .groupBy("ticker").agg(F.count("*").alias("null_count"))
    )


def stale_keys(bars: DataFrame, expected: DataFrame, as_of: date, max_days: int) -> DataFrame:
    """Expected tickers whose newest bar is more than `max_days` old; empty ones are skipped."""
    newest = bars.groupBy("ticker").agg(F.max("date").alias("latest_date"))
    return (
        expected.join(newest, "ticker")
        .withColumn("days_old", F.datediff(F.lit(as_of), "latest_date"))
        .where(F.col("days_old") > max_days)
    )


def findings(bars: DataFrame, expected: DataFrame, as_of: date, max_days: int) -> DataFrame:
    """(ticker, check, message) for every finding, from one aggregate over the bars."""
    per_ticker = bars.groupBy("ticker").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("adj_close").isNull()).alias("nulls"),
        F.max("date").alias("latest"),
    )
    state = (
        expected.withColumn("_expected", F.lit(True))
        .join(per_ticker, "ticker", "full")
        .withColumn("days_old", F.datediff(F.lit(as_of), "latest"))
    )
    wanted = F.col("_expected").isNotNull()
    # The message texts.
    missing = F.when(wanted & F.col("rows").isNull(), F.struct(
        F.lit("missing").alias("check"),
        F.format_string("No rows found for ticker %s", "ticker").alias("message")))
    nulls = F.when(F.col("nulls") > 0, F.struct(
        F.lit("null_price").alias("check"),
        F.format_string("Ticker %s has %d row(s) with NULL adj_close", "ticker", "nulls")
        .alias("message")))
    stale = F.when(wanted & (F.col("days_old") > max_days), F.struct(
        F.lit("stale").alias("check"),
        F.format_string("Ticker %s data is stale: latest date is %s (%d days ago)",
                        "ticker", F.date_format("latest", "yyyy-MM-dd"), "days_old")
        .alias("message")))
    return state.select(
        "ticker", F.inline(F.array_compact(F.array(missing, nulls, stale))))


def quality_report(bars: DataFrame, expected: DataFrame, as_of: date,
                   max_days: int) -> DataFrame:
    """One row per ticker with findings (three at most), their messages joined by newlines."""
    return (
        findings(bars, expected, as_of, max_days)
        .groupBy("ticker")
        .agg(F.count("*").alias("findings"),
             F.array_join(F.sort_array(F.collect_list("message")), "\n").alias("message"))
    )


class QualityError(Exception):
    """Raised once, after every check has run."""


def raise_on_findings(report: DataFrame, table: str) -> None:
    """Fail the job if the report has rows. Every message is in the stored report, whose
    place the error names beside the counts of each check."""
    tickers, total = report.agg(
        F.count("*"), F.coalesce(F.sum("findings"), F.lit(0))).first()
    if tickers:
        raise QualityError(f"{total} finding(s) for {tickers} ticker(s); all messages are in {table}")
