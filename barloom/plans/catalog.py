"""The registered queries: every operator over the test tables.

Each entry takes (spark, sf_dir). Bars and macro series are derived from the tables by
`sources.derived`; parameters are fixed in `SETTINGS`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..functions import series as S
from ..operators import drift as D
from ..operators import insert as I
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators.asof import asof_calendar, asof_keyed
from ..operators.logistic import feature_weights, fit_logistic
from ..operators.recent import last_rows_per_key, latest_per_key
from ..operators.scaler import fit_scaler, scaler_params
from ..schemas import BAR_COLS, BASE_TABLES, MACRO_COLS, PRIMARY_KEYS
from ..session import materialize, scratch_path
from ..settings import FEATURE_COLS, MACRO_SERIES, Settings, parse_list
from ..sources import derived as src
from ..sources import landing as L
from ..sources.store import Store
from ..streaming.arrivals import load_arrivals
from . import features as P
from . import ingest as G
from . import scoring as V
from . import training as R

SETTINGS = Settings(
    as_of=date(2001, 8, 2), cutoff=date(2000, 8, 1),
    tickers=parse_list("1-URGENT,2-HIGH,3-MEDIUM,4-NOT SPECIFIED,5-LOW"),
)
MISSING_TICKER = "9-MISSING"
WITH_MISSING = replace(SETTINGS, tickers=(*SETTINGS.tickers, MISSING_TICKER))
DAILY = replace(SETTINGS, lookback_years=50, load_stale_days=10)
EXISTING_BEFORE, INCOMING_FROM = date(2001, 1, 1), date(2000, 12, 1)
STALE_TICKER, STALE_AFTER = "5-LOW", date(2001, 7, 1)
BAD_TICKER, BAD_SERIES, BAD_DAY = "3-MEDIUM", "VIXCLS", 13
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Round every double, for comparison with another engine."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.selectExpr(*(f"round({c}, {DIGITS}) AS {c}" if c in doubles else c for c in df.columns))


def _features(spark: SparkSession, sf: str) -> DataFrame:
    lines = src.table(spark, sf, "lineitem")
    return P.build_features(src.bars(spark, sf, lines), src.macro(spark, sf, lines))


def _features_wide(spark: SparkSession, sf: str, chunk_rows: int | None = None) -> DataFrame:
    lines = src.table(spark, sf, "lineitem")
    return P.build_features(src.bars_wide(spark, sf, lines), src.macro(spark, sf, lines),
                            chunk_rows=chunk_rows)


def _expected(spark: SparkSession) -> DataFrame:
    return G.entity_frame(spark, "ticker", [*SETTINGS.tickers, MISSING_TICKER])


# --- scans and projections -------------------------------------------------------------

def scan_bars(spark, sf):
    start, end = date(1998, 1, 1), SETTINGS.cutoff
    return L.select_bars(src.bars(spark, sf, start=start, end=end), SETTINGS.tickers[:3], start, end)


def scan_macro(spark, sf):
    described = spark.createDataFrame(
        [(k, text) for k, (_, text) in MACRO_SERIES.items()], "series_id string, description string")
    chosen = L.select_macro(src.macro(spark, sf), list(MACRO_SERIES), date(1998, 1, 1))
    return chosen.join(described, "series_id")


def scan_macro_series(spark, sf):
    return L.macro_series(src.macro(spark, sf), "VIXCLS", "vix")


def scan_landing(fmt: str) -> Query:
    """Write bars to a landing folder, one directory per ticker, and read it back."""
    def run(spark, sf):
        path = scratch_path(spark, f"landing_{fmt}")
        src.bars(spark, sf).select(*BAR_COLS).write.partitionBy("ticker").format(fmt).save(path)
        return L.read_landing(spark, path, fmt, L.BARS).where(F.col("_bad") == "").drop("_bad", "_raw")
    return run


def normalize_columns(spark, sf):
    named = N.normalize_columns(src.download_shape(src.bars(spark, sf)))
    return named.withColumn("date", F.to_date("date")).select(*BAR_COLS)


def drop_null_rows(spark, sf):
    dirty = src.bars_dirty(src.bars(spark, sf)).select("ticker", "date", "adj_close", "volume")
    return I.drop_null_rows(dirty, ["adj_close"])


def union_batches(spark, sf):
    bars = src.bars(spark, sf).select("ticker", "date", "adj_close", "volume")
    old = bars.where(F.col("date") < F.lit(EXISTING_BEFORE)).withColumn("batch", F.lit("existing"))
    new = bars.where(F.col("date") >= F.lit(INCOMING_FROM)).withColumn("batch", F.lit("incoming"))
    return old.unionByName(new)


# --- tables and loads ------------------------------------------------------------------

def _store(spark, name) -> Store:
    return Store(spark, scratch_path(spark, name))


def _seeded(spark, feed: G.Feed, rows: DataFrame) -> Store:
    store = _store(spark, feed.table)
    store.create_missing([feed.table])
    store.append(feed.table, rows.where(F.col("date") < F.lit(EXISTING_BEFORE)))
    return store


def _incoming(rows: DataFrame, value: str) -> DataFrame:
    """The overlapping batch, every row twice, priced apart from the stored rows: the
    stored row must win over both copies and the first copy over the second."""
    new = rows.where(F.col("date") >= F.lit(INCOMING_FROM))
    copies = F.explode(F.array(F.lit(1), F.lit(2)))
    return (new.withColumn("ingest_seq", copies)
            .withColumn(value, F.col(value) + F.col("ingest_seq") - 0.5)
            .withColumn("_bad", F.lit("")))


def _load(feed: G.Feed, rows: Callable[[SparkSession, str], DataFrame], incremental: bool) -> Query:
    def run(spark, sf):
        source = materialize(rows(spark, sf).select(*feed.columns), f"{feed.table}_source")
        store = _seeded(spark, feed, source)
        G.run_load(store, feed, _incoming(source, feed.required), SETTINGS, "20010802_000000",
                   incremental=incremental)
        return store.read(feed.table).drop("ingested_at")
    return run


load_bars = _load(G.PRICES, src.bars, incremental=False)
load_macro = _load(G.MACRO, src.macro, incremental=False)


def incremental_load(spark, sf):
    """The whole table after a load behind the watermark. Bars of today and later, planted
    in the batch, must stay out."""
    def with_later(spark, sf):
        bars = src.bars(spark, sf).select(*BAR_COLS)
        last = bars.where(F.col("date") >= F.lit(SETTINGS.as_of) - F.expr("INTERVAL 60 DAYS"))
        later = [last.withColumn("date", F.date_add(F.lit(SETTINGS.as_of), n)) for n in (0, 1, 30)]
        out = bars.where(F.col("date") < F.lit(SETTINGS.as_of))
        for rows in later:
            out = out.unionByName(rows.dropDuplicates(["ticker"]))
        return out
    return _load(G.PRICES, with_later, incremental=True)(spark, sf)


def streaming_load(spark, sf):
    source = materialize(src.bars(spark, sf).select(*BAR_COLS), "raw_prices_source")
    store = _seeded(spark, G.PRICES, source)
    landing = scratch_path(spark, "arrivals")
    fresh = source.where(F.col("date") >= F.lit(INCOMING_FROM))
    fresh.write.partitionBy("ticker").json(landing)
    load_arrivals(spark, landing, "json", store, SETTINGS,
                  scratch_path(spark, "arrivals_log")).awaitTermination()
    return store.read("raw_prices").drop("ingested_at")


def load_watermark(spark, sf):
    """From the state that the appends keep; the stored bars are not read."""
    store = _seeded(spark, G.PRICES, src.bars(spark, sf).select(*BAR_COLS))
    return I.load_watermark(store.high_water("raw_prices"), _expected(spark), "ticker",
                            SETTINGS.as_of, SETTINGS.lookback_years)


def _audited_loads(spark, sf) -> Store:
    """Both feeds as text batches; one ticker and one series hold values that do not parse."""
    def text_batch(rows, schema, key, bad_key, column):
        new = rows.where(F.col("date") >= F.lit(INCOMING_FROM)).select(
            *(F.col(f.name).cast("string").alias(f.name) for f in schema))
        spoiled = (F.col(key) == bad_key) & (F.dayofmonth(F.to_date("date")) == BAD_DAY)
        parsed = L.parse_text(
            new.withColumn(column, F.when(spoiled, "n/a").otherwise(F.col(column))), schema)
        return parsed.withColumn("ingest_seq", F.lit(1))

    store = _store(spark, "audited")
    bars = src.bars_dirty(src.bars(spark, sf))
    for feed, rows, schema, bad_key, column in (
            (G.PRICES, bars, L.BARS, BAD_TICKER, "volume"),
            (G.MACRO, src.macro(spark, sf), L.MACRO, BAD_SERIES, "value")):
        G.run_load(store, feed, text_batch(rows, schema, feed.key, bad_key, column),
                   WITH_MISSING, "20010802_000000", incremental=False)
    return store


def ingestion_audit(spark, sf):
    """The log as stored by the loads."""
    return _audited_loads(spark, sf).read("ingestion_log").drop("started_at", "finished_at")


def rejected_rows(spark, sf):
    """What the loads refused, by the date in the kept text."""
    return _audited_loads(spark, sf).read("rejected").withColumn(
        "date", F.to_date(F.get_json_object("raw", "$.date"))).drop("raw")


def damaged_files(spark, sf):
    """The log of a load from Parquet files, of which one ticker's is cut short."""
    landing = scratch_path(spark, "landing")
    bars = src.bars(spark, sf).select(*BAR_COLS).where(F.col("date") >= F.lit(INCOMING_FROM))
    bars.repartition("ticker").write.partitionBy("ticker").parquet(landing)
    L.plant_damaged_file(spark, f"{landing}/ticker={BAD_TICKER}")
    batch = L.read_landing(spark, landing, "parquet", L.BARS).withColumn("ingest_seq", F.lit(1))
    store = _store(spark, "damaged")
    G.run_load(store, G.PRICES, batch, SETTINGS, "20010802_000000", incremental=False)
    return store.read("ingestion_log").drop("started_at", "finished_at")


def _daily_run(spark, sf, bars: DataFrame) -> Store:
    """Load, check, build. The store is returned whether or not the check stopped the build."""
    store = _store(spark, "daily")
    ready = lambda rows: rows.withColumn("ingest_seq", F.lit(1)).withColumn("_bad", F.lit(""))
    try:
        G.daily_run(store, ready(bars.select(*BAR_COLS)), ready(src.macro(spark, sf)),
                    DAILY, "20010802_000000")
    except Q.QualityError:
        pass
    return store


def daily_run(spark, sf):
    """The features that a daily run without findings has built."""
    return rounded(_daily_run(spark, sf, src.bars(spark, sf)).read("features").drop("computed_at"))


def daily_run_stopped(spark, sf):
    """The report of a daily run in which one ticker ends too early, and how many features it built."""
    bars = src.bars(spark, sf).where((F.col("ticker") != STALE_TICKER) | (F.col("date") <= F.lit(STALE_AFTER)))
    store = _daily_run(spark, sf, bars)
    return store.read("quality_report").crossJoin(
        store.read("features").agg(F.count(F.lit(1)).alias("feature_rows")))


def table_schemas(spark, sf):
    """Create the base tables, fill two of them, and report every column as stored: its
    type in the files, whether the table was declared to allow NULLs, its NULLs, and the
    table's rows and repeated keys."""
    store = _store(spark, "schemas")
    store.create_missing()
    store.append("raw_prices", src.bars(spark, sf))
    store.append("raw_macro", src.macro(spark, sf))
    store.append("ingestion_log", store.read("ingestion_log"))
    reports = []
    for name, schema in BASE_TABLES.items():
        stored, types, declared = store.read(name), store.stored_types(name), store.declared(name)
        nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in schema.names]
        distinct_keys = F.lit(0).cast("bigint")
        if name in PRIMARY_KEYS:
            keys = list(PRIMARY_KEYS[name])
            partial = stored.groupBy(*keys).agg(
                F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"_null_{c}")
                                            for c in schema.names))
            totals = partial.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.count("*").alias("_keys"),
                *(F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(c) for c in schema.names))
            distinct_keys = F.col("_rows") - F.col("_keys")
        else:
            totals = stored.agg(F.count("*").alias("_rows"), *nulls)
        reports.append(totals.select(F.lit(name).alias("table_name"), F.inline(F.array(*(
            F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(types[f.name]).alias("data_type"),
                     F.lit(declared[f.name].nullable).alias("nullable"),
                     F.col(f.name).alias("null_count"),
                     F.col("_rows").alias("row_count"),
                     distinct_keys.alias("repeated_keys"))
            for f in schema)))))
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


# --- as-of joins -----------------------------------------------------------------------

def asof_one(series_id: str) -> Query:
    column = MACRO_SERIES[series_id][0]

    def run(spark, sf):
        bars = src.bars(spark, sf).select("ticker", "date", "adj_close")
        return asof_calendar(bars, src.macro(spark, sf), {series_id: column})
    return run


def asof_chain(spark, sf):
    bars = src.bars(spark, sf).select("ticker", "date", "adj_close")
    return asof_calendar(bars, src.macro(spark, sf), P.MACRO_COLUMNS)


def asof_nulls(spark, sf):
    """FEDFUNDS starts late and one of its values is NULL: earlier bars go, and bars after
    the NULL see NULL."""
    macro = src.macro(spark, sf)
    fed = F.col("series_id") == "FEDFUNDS"
    late = macro.where(~fed | (F.col("date") >= F.lit(date(1995, 6, 1)))).withColumn(
        "value", F.when(fed & (F.col("date") == F.lit(date(1997, 3, 1))), None)
        .otherwise(F.col("value")))
    bars = src.bars(spark, sf).select("ticker", "date", "adj_close")
    return asof_calendar(bars, late, P.MACRO_COLUMNS)


def asof_far_date(spark, sf):
    """A stray observation at the end of the calendar changes no bar before it."""
    macro = src.macro(spark, sf)
    stray = spark.createDataFrame([("FEDFUNDS", date(9999, 12, 30), 99.0)], "series_id string, date date, value double")
    bars = src.bars(spark, sf).select("ticker", "date", "adj_close")
    return asof_calendar(bars, macro.select("series_id", "date", "value").unionByName(stray), P.MACRO_COLUMNS)


def _purchases_and_clicks(spark, sf):
    events = src.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    of = lambda kind: events.where(F.col("event_type") == kind).drop("event_type")
    return of("purchase"), of("click")


def asof_keyed_query(spark, sf):
    purchases, clicks = _purchases_and_clicks(spark, sf)
    return asof_keyed(purchases, clicks, ["user_id"], "ts",
                      {"event_id": "click_id", "value": "click_value"})


def asof_keyed_sliced(spark, sf):
    """The same join with every user's history cut by the hour."""
    purchases, clicks = _purchases_and_clicks(spark, sf)
    return asof_keyed(purchases, clicks, ["user_id"], "ts",
                      {"event_id": "click_id", "value": "click_value"},
                      unit=lambda t: F.date_trunc("hour", t))


def asof_keyed_ties(spark, sf):
    """Both sides by day, so that many clicks share a moment: the greatest id wins."""
    purchases, clicks = (d.withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
                         for d in _purchases_and_clicks(spark, sf))
    return asof_keyed(purchases, clicks, ["user_id"], "ts",
                      {"event_id": "click_id", "value": "click_value"}, tie="event_id",
                      unit=lambda t: F.date_trunc("month", t))


def asof_keyed_nulls(spark, sf):
    """Purchases without a user or a time, which match nothing but stay."""
    purchases, clicks = _purchases_and_clicks(spark, sf)
    gone = lambda c, n: F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)      # noqa: E731
    return asof_keyed(purchases.select("event_id", gone("user_id", 7), gone("ts", 5), "value"),
                      clicks.select("event_id", gone("user_id", 3), gone("ts", 4), "value"),
                      ["user_id"], "ts", {"event_id": "click_id", "value": "click_value"})


# --- windows ---------------------------------------------------------------------------

def window_column(name: str) -> Query:
    """One rolling column of every bar, before the as-of join."""
    def run(spark, sf):
        bars = src.bars(spark, sf).select("ticker", "date", "adj_close", "volume")
        return rounded(P.add_windows(bars).select("ticker", "date", name))
    return run


def rsi_14(spark, sf):
    """RSI of every bar."""
    w = S.ordered("ticker")
    bars = (src.bars(spark, sf).withColumn("_previous", S.previous("adj_close", w))
            .withColumn("return_1d", S.change_from("_previous", "adj_close")))
    return rounded(S.with_rsi(bars, "return_1d", w).select("ticker", "date", "rsi_14"))


# --- feature table ---------------------------------------------------------------------

def features(spark, sf):
    return rounded(_features(spark, sf))


def features_stored(spark, sf):
    """The rebuilt table, read back for a date range."""
    store = _store(spark, "features")
    store.replace_features(_features(spark, sf))
    return rounded(store.read_between("features", SETTINGS.cutoff, SETTINGS.as_of).drop("computed_at"))


def features_wide(spark, sf):
    return rounded(_features_wide(spark, sf))


def features_wide_chunked(spark, sf):
    return rounded(_features_wide(spark, sf, chunk_rows=128))


def feature_summary(spark, sf):
    return P.feature_summary(_features(spark, sf))


def rsi_update_join(spark, sf):
    """Placeholder features updated from a separately computed RSI table."""
    built = materialize(_features(spark, sf), "features").drop("rsi_14")
    w = S.ordered("ticker")
    rsi = S.with_rsi(built.select("ticker", "date", "return_1d"), "return_1d", w)
    update = rsi.select("ticker", "date", "rsi_14").where(F.col("rsi_14").isNotNull())
    empty = built.withColumn("rsi_14", F.lit(None).cast("double"))
    return rounded(P.rsi_update(empty, update).select("ticker", "date", "return_1d", "rsi_14"))


# --- quality ---------------------------------------------------------------------------

def _defective(spark, sf):
    bars = src.bars_dirty(src.bars(spark, sf)).select("ticker", "date", "adj_close", "volume")
    return bars.where((F.col("ticker") != STALE_TICKER) | (F.col("date") <= F.lit(STALE_AFTER)))


def check_missing_keys(spark, sf):
    return Q.missing_keys(src.bars(spark, sf).select("ticker", "date"), _expected(spark))


def check_null_values(spark, sf):
    return Q.null_values(_defective(spark, sf))


def check_staleness(spark, sf):
    return Q.stale_keys(_defective(spark, sf), _expected(spark), SETTINGS.as_of,
                        SETTINGS.load_stale_days)


def quality_report(spark, sf):
    return Q.quality_report(_defective(spark, sf), _expected(spark), SETTINGS.as_of,
                            SETTINGS.load_stale_days)


# --- serving reads ---------------------------------------------------------------------

def latest_features(spark, sf):
    return rounded(V.latest_features(_features(spark, sf), SETTINGS))


def last_30_rows(spark, sf):
    return rounded(last_rows_per_key(_features(spark, sf), SETTINGS.recent_rows))


def latest_wide(spark, sf):
    return latest_per_key(src.bars_wide(spark, sf))


def last_30_wide(spark, sf):
    return last_rows_per_key(src.bars_wide(spark, sf), SETTINGS.recent_rows)


# --- dataset, scaling, metrics ---------------------------------------------------------

def training_rows(spark, sf):
    return rounded(R.training_rows(_features(spark, sf)))


def temporal_split(spark, sf):
    return (R.with_split(R.training_rows(_features(spark, sf)), SETTINGS)
            .groupBy("split").agg(F.count("*").alias("n_rows"), F.sum("target").alias("positives"),
                                  F.min("date").alias("first_date"), F.max("date").alias("last_date")))


def _split(spark, sf):
    rows = R.training_rows(_features(spark, sf))
    return rows.where(R.is_train(SETTINGS)), rows.where(~R.is_train(SETTINGS))


def scaler_params_query(spark, sf):
    return rounded(scaler_params(_split(spark, sf)[0], FEATURE_COLS))


def scaled_features(spark, sf):
    rows = materialize(R.training_rows(_features(spark, sf)), "training_rows")
    scaler = fit_scaler(rows.where(R.is_train(SETTINGS)), FEATURE_COLS)
    return rounded(scaler.transform(rows))


def majority_class(spark, sf):
    return M.majority_class(_split(spark, sf)[0])


def baseline_accuracy(spark, sf):
    rows = materialize(R.training_rows(_features(spark, sf)).select("date", "target"), "labels")
    return M.baseline_accuracy(rows.where(R.is_train(SETTINGS)), rows.where(~R.is_train(SETTINGS)))


def classification_metrics(spark, sf):
    """The metrics of a reversal rule: up after a fall."""
    test = _split(spark, sf)[1]
    ruled = test.withColumn("prediction", (F.col("return_1d") < 0).cast("int"))
    return M.classification_metrics(ruled)


# --- drift -----------------------------------------------------------------------------

def drift_reference_window(spark, sf):
    return rounded(_features(spark, sf).where(D.in_reference(SETTINGS.cutoff)).select(*FEATURE_COLS))


def drift_current_window(spark, sf):
    return rounded(_features(spark, sf)
                   .where(D.in_current(SETTINGS.as_of, SETTINGS.drift_days)).select(*FEATURE_COLS))


def drift_window_counts(spark, sf):
    return D.window_counts(_features(spark, sf), SETTINGS.cutoff, SETTINGS.as_of, SETTINGS.drift_days)


def _drift(spark, sf):
    return D.drift_statistics(_features(spark, sf), FEATURE_COLS, SETTINGS.cutoff, SETTINGS.as_of,
                              SETTINGS.drift_days)


def drift_report(spark, sf):
    """The KS report, stored under its run date and read back."""
    store = _store(spark, "drift")
    store.write_drift(D.drift_report(_drift(spark, sf), "ks"), SETTINGS.as_of)
    return rounded(store.read_drift())


def drift_wasserstein(spark, sf):
    return rounded(D.drift_report(_drift(spark, sf), "wasserstein"))


def drift_auto(spark, sf):
    return rounded(D.drift_report(_drift(spark, sf), "auto"))


def drift_summary(spark, sf):
    return D.drift_summary(D.drift_report(_drift(spark, sf), "ks"))


# --- models ----------------------------------------------------------------------------

def _stored_features(spark, sf):
    return materialize(_features(spark, sf), "features")


def _trained(spark, sf):
    feats = _stored_features(spark, sf)
    rows = materialize(R.training_rows(feats), "training_rows")
    return feats, rows, R.train(rows, SETTINGS)


def _with_logistic(rows: DataFrame) -> R.Model:
    """A model without a forest, for queries that need only the regression."""
    train = rows.where(R.is_train(SETTINGS))
    scaler = fit_scaler(train, FEATURE_COLS)
    return R.Model(scaler, fit_logistic(scaler.transform(train), FEATURE_COLS), None)


def _fit_logistic(spark, sf):
    rows = materialize(R.training_rows(_features(spark, sf)), "training_rows")
    return rows, _with_logistic(rows)


def logistic_fit(spark, sf):
    """Coefficients and intercept by position."""
    return rounded(_fit_logistic(spark, sf)[1].logistic.to_frame(spark))


def feature_weights_query(spark, sf):
    return rounded(feature_weights(spark, _fit_logistic(spark, sf)[1].logistic))


def logistic_predictions(spark, sf):
    rows, model = _fit_logistic(spark, sf)
    test = rows.where(~R.is_train(SETTINGS))
    return rounded(R.with_prediction(test, model)
                   .select("ticker", "date", "target", "probability_up", "prediction"))


def _fit_forest(spark, sf):
    rows = materialize(R.training_rows(_features(spark, sf)), "training_rows")
    train = rows.where(R.is_train(SETTINGS))
    scaler = fit_scaler(train, FEATURE_COLS)
    forest = R.train_forest(scaler.transform(train), train.count(), SETTINGS)
    return rows, R.Model(scaler, None, forest)


def iforest_fit(spark, sf):
    """The node table."""
    return rounded(_fit_forest(spark, sf)[1].forest.nodes)


def anomaly_scores(spark, sf):
    rows, model = _fit_forest(spark, sf)
    scored = R.with_anomaly(R.with_split(rows, SETTINGS), model)
    return rounded(scored.select("ticker", "date", "split", "anomaly_score", "is_anomaly"))


def anomaly_sample(spark, sf):
    rows, model = _fit_forest(spark, sf)
    return R.anomaly_sample(R.with_anomaly(rows.where(~R.is_train(SETTINGS)), model))


def model_evaluation(spark, sf):
    _, rows, model = _trained(spark, sf)
    return R.evaluate(rows, model, SETTINGS)


def model_metadata(spark, sf):
    """The metadata document after training and evaluation, without its run time."""
    store = _store(spark, "model")
    _, rows, model = _trained(spark, sf)
    R.save_model(store, model, SETTINGS)
    R.save_evaluation(store, R.evaluate(rows, model, SETTINGS))
    return store.read_metadata("evaluated").drop("train_date").withColumn(
        "feature_cols", F.concat_ws(",", "feature_cols"))


def model_roundtrip(spark, sf):
    """Predictions and scores of the test rows from the fitted and the reloaded model."""
    store = _store(spark, "model")
    _, rows, model = _trained(spark, sf)
    R.save_model(store, model, SETTINGS)
    again = R.load_model(store)
    test = rows.where(~R.is_train(SETTINGS))

    def scored(m, tag):
        return R.with_anomaly(R.with_prediction(test, m), m).select(
            "ticker", "date", F.col("probability_up").alias(f"probability_{tag}"),
            F.col("anomaly_score").alias(f"score_{tag}"))
    return rounded(scored(model, "fitted").join(scored(again, "loaded"), ["ticker", "date"]))


def model_status(spark, sf):
    store = _store(spark, "model")
    _, rows, model = _trained(spark, sf)
    R.save_model(store, model, SETTINGS)
    R.save_evaluation(store, R.evaluate(rows, model, SETTINGS))
    status = V.model_status(store).drop("model_train_date").withColumn(
        "feature_cols", F.concat_ws(",", "feature_cols"))
    return status.select("*", "artifacts_present.*").drop("artifacts_present")


def score_latest(spark, sf):
    feats = _stored_features(spark, sf)
    model = _with_logistic(R.training_rows(feats))
    return rounded(V.score_latest(feats, model, SETTINGS, _expected(spark)).drop("model_train_date"))


def score_without_model(spark, sf):
    """Scores asked of a store that holds no artifact."""
    model = R.load_model(_store(spark, "no_model"))
    return V.score_latest(_features(spark, sf), model, SETTINGS, _expected(spark))


def recent_anomalies(spark, sf):
    feats, _, model = _trained(spark, sf)
    listed = V.recent_anomalies(feats, model, SETTINGS, _expected(spark))
    return listed.select("ticker", "window_days", "anomaly_rate", "status",
                         F.explode_outer("anomalies").alias("a")).select("*", "a.*").drop("a")


QUERIES: dict[str, Query] = {
    "scan_bars": scan_bars,
    "scan_macro": scan_macro,
    "scan_macro_series": scan_macro_series,
    "scan_landing_csv": scan_landing("csv"),
    "scan_landing_json": scan_landing("json"),
    "scan_landing_parquet": scan_landing("parquet"),
    "normalize_columns": normalize_columns,
    "drop_null_rows": drop_null_rows,
    "union_batches": union_batches,
    "table_schemas": table_schemas,
    "load_bars": load_bars,
    "load_macro": load_macro,
    "incremental_load": incremental_load,
    "streaming_load": streaming_load,
    "load_watermark": load_watermark,
    "ingestion_audit": ingestion_audit,
    "rejected_rows": rejected_rows,
    "damaged_files": damaged_files,
    "daily_run": daily_run,
    "daily_run_stopped": daily_run_stopped,
    "asof_fedfunds": asof_one("FEDFUNDS"),
    "asof_cpiaucsl": asof_one("CPIAUCSL"),
    "asof_vix": asof_one("VIXCLS"),
    "asof_t10y2y": asof_one("T10Y2Y"),
    "asof_chain": asof_chain,
    "asof_nulls": asof_nulls,
    "asof_far_date": asof_far_date,
    "asof_keyed": asof_keyed_query,
    "asof_keyed_sliced": asof_keyed_sliced,
    "asof_keyed_ties": asof_keyed_ties,
    "asof_keyed_nulls": asof_keyed_nulls,
    "return_1d": window_column("return_1d"),
    "ma_5": window_column("ma_5"),
    "ma_20": window_column("ma_20"),
    "ma_50": window_column("ma_50"),
    "volatility_20": window_column("volatility_20"),
    "volume_zscore": window_column("volume_zscore"),
    "target_label": window_column("target"),
    "rsi_14": rsi_14,
    "features": features,
    "features_stored": features_stored,
    "features_wide": features_wide,
    "features_wide_chunked": features_wide_chunked,
    "feature_summary": feature_summary,
    "rsi_update_join": rsi_update_join,
    "check_missing_keys": check_missing_keys,
    "check_null_values": check_null_values,
    "check_staleness": check_staleness,
    "quality_report": quality_report,
    "latest_features": latest_features,
    "last_30_rows": last_30_rows,
    "latest_wide": latest_wide,
    "last_30_wide": last_30_wide,
    "training_rows": training_rows,
    "temporal_split": temporal_split,
    "scaler_params": scaler_params_query,
    "scaled_features": scaled_features,
    "majority_class": majority_class,
    "baseline_accuracy": baseline_accuracy,
    "classification_metrics": classification_metrics,
    "drift_reference_window": drift_reference_window,
    "drift_current_window": drift_current_window,
    "drift_window_counts": drift_window_counts,
    "drift_report": drift_report,
    "drift_wasserstein": drift_wasserstein,
    "drift_auto": drift_auto,
    "drift_summary": drift_summary,
    "logistic_fit": logistic_fit,
    "feature_weights": feature_weights_query,
    "logistic_predictions": logistic_predictions,
    "iforest_fit": iforest_fit,
    "anomaly_scores": anomaly_scores,
    "anomaly_sample": anomaly_sample,
    "model_evaluation": model_evaluation,
    "model_metadata": model_metadata,
    "model_roundtrip": model_roundtrip,
    "model_status": model_status,
    "score_latest": score_latest,
    "score_without_model": score_without_model,
    "recent_anomalies": recent_anomalies,
}
