"""The daily load: batch -> audit -> insert-if-absent -> audit table, for bars and macro."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import audit_rows, loadable, raise_on_failures, rejected
from ..operators.quality import quality_report, raise_on_findings
from ..operators.insert import after_watermark, insert_if_absent, load_watermark
from ..schemas import BAR_COLS, MACRO_COLS
from ..session import materialize
from ..settings import MACRO_SERIES, MACRO_SOURCE, PRICE_SOURCE, Settings
from ..sources.store import Commit, Store
from .features import build_features


@dataclass(frozen=True)
class Feed:
    """How one base table is loaded."""
    table: str
    key: str
    required: str
    columns: tuple[str, ...]
    source: str
    label: str


PRICES = Feed("raw_prices", "ticker", "adj_close", BAR_COLS, PRICE_SOURCE, "tickers")
MACRO = Feed("raw_macro", "series_id", "value", MACRO_COLS, MACRO_SOURCE, "series")


def entity_frame(spark: SparkSession, key: str, names: Sequence[str]) -> DataFrame:
    """Configured entities, read from settings on the driver."""
    return spark.createDataFrame([(n,) for n in names], f"{key} string")


def configured(feed: Feed, settings: Settings) -> Sequence[str]:
    return settings.tickers if feed is PRICES else tuple(MACRO_SERIES)


def run_load(store: Store, feed: Feed, batch: DataFrame, settings: Settings, run_id: str,
             incremental: bool = True, pending: str | None = None) -> DataFrame:
    """Load one batch and return its rows of the ingestion log.

    The batch needs the feed's columns, `_bad`, and `ingest_seq`, which orders copies of
    a key. It is written once to the scratch folder: audit, key check and append then
    read that copy instead of the source. Bars dated today or later wait for a later load.

    Loaded rows, rejected rows, the log and the high-water marks become visible in one commit,
    which a run id gets once: the same run again does nothing, and a run that broke off has
    left nothing. With `pending`, good rows of failed entities are written there, for the
    caller to hand in again.
    """
    spark = store.spark
    run = f"{feed.table}/{run_id}"
    if store.done(run):
        return store.read("ingestion_log").where(
            (F.col("run_id") == run_id) & (F.col("source") == feed.source))
    names = configured(feed, settings)
    entities = entity_frame(spark, feed.key, names)
    raw = F.col("_raw") if "_raw" in batch.columns else F.lit(None).cast("string").alias("_raw")
    batch = batch.select(*feed.columns, "ingest_seq", "_bad", raw)
    with store.begin(run) as commit:
        if incremental:
            marks = load_watermark(store.high_water(feed.table), entities, feed.key, settings.as_of,
                                   settings.lookback_years)
            batch = after_watermark(batch, marks, feed.key,
                                    settings.as_of if feed is PRICES else None)
        staged = materialize(batch, f"{feed.table}_batch")
        audit = materialize(
            audit_rows(staged, entities, feed.key, feed.required, feed.source, run_id)
            .withColumn("started_at", F.current_timestamp()), f"{feed.table}_audit")
        good = loadable(staged, audit, feed.key, [*feed.columns, "ingest_seq"], feed.required)
        if not audit.where("status = 'failed'").isEmpty():       # else every row can be loaded
            commit.add("rejected", rejected(staged, entities, feed.key).withColumns(
                {"table_name": F.lit(feed.table), "run_id": F.lit(run_id)}))
        if pending is not None:
            loadable(staged, audit, feed.key, [*feed.columns, "ingest_seq"], feed.required,
                     "failed").write.mode("overwrite").parquet(pending)
        fresh = insert_if_absent(_overlap(commit, feed, staged, names), good, [feed.key, "date"],
                                 "ingest_seq")
        commit.add(feed.table, fresh, known_new=True)
        return commit.add("ingestion_log", audit.withColumn("finished_at", F.current_timestamp()))


def _overlap(commit: Commit, feed: Feed, staged: DataFrame, names: Sequence[str]) -> DataFrame:
    """The stored rows that can clash with the batch: those of configured entities within its
    dates. Years prune the folders of bars, series those of observations."""
    first, last = staged.agg(F.min("date"), F.max("date")).first()
    stored = commit.read_between(feed.table, start=first, last=last)
    return stored.where(F.col(feed.key).isin(list(names)))


def daily_load(store: Store, bars: DataFrame, macro: DataFrame, settings: Settings,
               run_id: str) -> DataFrame:
    """Load both feeds, then fail once if any entity failed. Returns both feeds' log rows."""
    prices = run_load(store, PRICES, bars, settings, run_id)
    series = run_load(store, MACRO, macro, settings, run_id)
    raise_on_failures(prices, PRICES.label)
    raise_on_failures(series, MACRO.label)
    return prices.unionByName(series)


def daily_run(store: Store, bars: DataFrame, macro: DataFrame, settings: Settings,
              run_id: str) -> DataFrame:
    """Load both feeds, check the stored bars, rebuild the features; returns these.

    The report is kept before the gate stops a run with findings, and the old features stay
    as they are until the new ones are complete. A run that failed can be handed in
    again: a load that is done is not repeated, and the newest report of a run counts.
    """
    daily_load(store, bars, macro, settings, run_id)
    entities = entity_frame(store.spark, PRICES.key, configured(PRICES, settings))
    with store.begin() as commit:
        earlier = commit.read("quality_report").where(F.col("run_id") != run_id)
        report = quality_report(commit.read("raw_prices"), entities, settings.as_of,
                                settings.load_stale_days).withColumn("run_id", F.lit(run_id))
        kept = commit.add("quality_report", earlier.unionByName(report), replace=True)
    raise_on_findings(kept.where(F.col("run_id") == run_id), f"{store.path('quality_report')}, run {run_id}")
    features = build_features(store.read("raw_prices"), store.read("raw_macro"), settings.lag_days)
    store.replace_features(features)
    return store.read("features")
