"""Batch scoring: the latest prediction and the recent anomalies of every ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.logistic import direction
from ..operators.recent import last_rows_per_key, latest_per_key
from ..settings import FEATURE_COLS, Settings
from ..sources.store import Store
from .training import Model, load_metadata, load_model, with_anomaly, with_prediction


def latest_features(features: DataFrame, settings: Settings) -> DataFrame:
    """Per ticker the newest row that has a return, and whether it is stale."""
    rows = (features.select("ticker", "date", *FEATURE_COLS)
            .where(F.col("return_1d").isNotNull()))
    age = F.datediff(F.lit(settings.as_of), "date")
    return latest_per_key(rows).withColumn("stale", age > settings.serving_stale_days)


def score_latest(features: DataFrame, model: Model, settings: Settings,
                 requested: DataFrame | None = None) -> DataFrame:
    """Direction and probability from the latest row of every (requested) ticker.

    `status` tells why a prediction is missing: not_found, model_unavailable, or
    incomplete_features.
    """
    latest = latest_features(features, settings)
    if requested is not None:
        latest = requested.join(latest, "ticker", "left")
    usable = model.scaler is not None and model.logistic is not None
    if usable:
        scored = with_prediction(latest, model)
    else:
        scored = latest.withColumn("probability_up", F.lit(None).cast("double"))
    p = F.col("probability_up")
    status = (
        F.when(F.col("date").isNull(), "not_found")
        .when(F.lit(not usable), "model_unavailable")
        .when(p.isNull(), "incomplete_features").otherwise("ok")
    )
    return scored.select(
        "ticker", direction(p).alias("prediction"), p,
        F.date_format("date", "yyyy-MM-dd").alias("last_feature_date"),
        F.lit(model.train_date).cast("string").alias("model_train_date"),
        F.when(F.col("stale"), "stale").when(F.col("date").isNotNull(), "ok")
        .alias("feature_freshness"),
        status.alias("status"),
    )


def recent_anomalies(features: DataFrame, model: Model, settings: Settings,
                     requested: DataFrame | None = None) -> DataFrame:
    """The anomaly flags of each ticker's last rows, oldest first, and their rate.

    Rows with missing features are listed with a NULL flag and left out of the rate. A
    list holds at most `settings.recent_rows` entries.
    """
    recent = last_rows_per_key(features.select("ticker", "date", *FEATURE_COLS),
                               settings.recent_rows)
    usable = model.scaler is not None and model.forest is not None
    if usable:
        flagged = with_anomaly(recent, model).select("ticker", "date", "is_anomaly")
    else:
        flagged = recent.select("ticker", "date", F.lit(None).cast("boolean").alias("is_anomaly"))
    listed = flagged.groupBy("ticker").agg(
        F.round(F.avg(F.col("is_anomaly").cast("double")), 4).alias("anomaly_rate"),
        F.sort_array(F.collect_list(F.struct(
            F.date_format("date", "yyyy-MM-dd").alias("date"), "is_anomaly"))).alias("anomalies"),
        F.bool_or(F.col("is_anomaly").isNull()).alias("incomplete"),
    )
    if requested is not None:
        listed = requested.join(listed, "ticker", "left")
    status = (
        F.when(F.col("anomalies").isNull(), "not_found")
        .when(F.lit(not usable), "model_unavailable")
        .when(F.col("incomplete"), "incomplete_features").otherwise("ok")
    )
    return listed.select("ticker", F.lit(settings.recent_rows).alias("window_days"),
                         "anomaly_rate", "anomalies", status.alias("status"))


def model_status(store: Store) -> DataFrame:
    """One row: health, metrics, feature list and which artifacts are present.

    The names of artifacts, fields and states are fixed values.
    """
    model, meta = load_model(store), load_metadata(store)
    present = {"logistic_regression": model.logistic is not None,
               "isolation_forest": model.forest is not None,
               "scaler": model.scaler is not None}
    fields = ("train_date", "train_cutoff_date", "lr_accuracy", "lr_f1", "baseline_accuracy",
              "iso_anomaly_rate")
    known = {f: meta[f] if meta else None for f in fields}
    return store.spark.createDataFrame(
        [("ok" if all(present.values()) else "degraded", *known.values(), list(FEATURE_COLS),
          tuple(present.values()))],
        "status string, model_train_date string, train_cutoff_date string, lr_accuracy double, "
        "lr_f1 double, baseline_accuracy double, iso_anomaly_rate double, "
        "feature_cols array<string>, artifacts_present struct<logistic_regression: boolean, "
        "isolation_forest: boolean, scaler: boolean>")
