"""Table schemas and the keys and NOT NULL columns that the load step enforces."""

from __future__ import annotations

from pyspark.sql import types as T

from .settings import FEATURE_COLS


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in columns])


_S, _D, _F, _L, _I, _TS = (
    T.StringType(), T.DateType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType(),
)

RAW_PRICES = _schema(
    ("ticker", _S, False), ("date", _D, False),
    ("open", _F, True), ("high", _F, True), ("low", _F, True), ("close", _F, True),
    ("adj_close", _F, False), ("volume", _L, True), ("ingested_at", _TS, True),
)

RAW_MACRO = _schema(
    ("series_id", _S, False), ("date", _D, False), ("value", _F, True), ("ingested_at", _TS, True),
)

INGESTION_LOG = _schema(
    ("run_id", _S, False), ("source", _S, False), ("ticker", _S, True),
    ("rows_loaded", _I, True), ("status", _S, True), ("error_msg", _S, True),
    ("started_at", _TS, True), ("finished_at", _TS, True),
)

FEATURES = _schema(
    ("ticker", _S, False), ("date", _D, False),
    *((name, _F, True) for name in FEATURE_COLS),
    ("target", _I, True), ("feature_version", _S, False), ("computed_at", _TS, False),
)

METADATA = _schema(
    ("train_date", _S, True), ("train_cutoff_date", _S, True),
    ("feature_cols", T.ArrayType(_S), True),
    ("n_train_rows", _L, True), ("n_test_rows", _L, True),
    ("lr_accuracy", _F, True), ("lr_precision", _F, True), ("lr_recall", _F, True),
    ("lr_f1", _F, True), ("baseline_accuracy", _F, True), ("iso_anomaly_rate", _F, True),
    ("majority_class", _I, True),
)

REJECTED = _schema(
    ("table_name", _S, False), ("run_id", _S, False),
    ("entity", _S, True), ("reason", _S, False), ("raw", _S, True),
)

# The newest stored date of every key, brought up to date by each commit.
HIGH_WATER = _schema(("table_name", _S, False), ("key", _S, False), ("newest", _D, False))

QUALITY_REPORT = _schema(
    ("run_id", _S, False), ("ticker", _S, False), ("findings", _L, False), ("message", _S, False),
)

PRIMARY_KEYS = {"raw_prices": ("ticker", "date"), "raw_macro": ("series_id", "date")}
BASE_TABLES = {"raw_prices": RAW_PRICES, "raw_macro": RAW_MACRO, "ingestion_log": INGESTION_LOG}
TABLES = {**BASE_TABLES, "features": FEATURES, "rejected": REJECTED, "high_water": HIGH_WATER,
          "quality_report": QUALITY_REPORT}

# Columns of a batch, before the load step stamps ingested_at.
BAR_COLS = tuple(f.name for f in RAW_PRICES if f.name != "ingested_at")
MACRO_COLS = tuple(f.name for f in RAW_MACRO if f.name != "ingested_at")
