"""Per-entity load results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "(unknown)"


def audit_rows(batch: DataFrame, entities: DataFrame, key: str, required: str, source: str,
               run_id: str) -> DataFrame:
    """One row per configured entity: rows loaded, status and error text.

    An entity without rows succeeds with 0. One with rows that did not parse, or have no
    date, fails as a whole with 0 rows, and the others go on. `rows_loaded` counts the batch
    after its NULL rows are dropped, whether or not the table already has them. Rows whose
    key is NULL or not configured make one more row, under the name UNKNOWN, if there are any.
    """
    counts = batch.groupBy(key).agg(
        F.count_if(readable() & F.col(required).isNotNull()).alias("good"),
        F.count_if(~readable()).alias("bad"), F.count(F.lit(1)).alias("every"),
    )
    failed = F.coalesce(F.col("bad") > 0, F.lit(False))
    shape = (F.lit(run_id).alias("run_id"), F.lit(source).alias("source"))
    known = entities.join(counts, key, "left").select(
        *shape, F.col(key).alias("ticker"),
        F.when(failed, F.lit(0)).otherwise(F.coalesce("good", F.lit(0))).cast("long").alias("rows_loaded"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.format_string("%d row(s) could not be parsed", "bad")).alias("error_msg"),
    )
    stray = counts.join(entities, key, "left_anti").agg(F.sum("every").alias("every")).where(
        F.col("every") > 0)
    return known.unionAll(stray.select(
        *shape, F.lit(UNKNOWN), F.lit(0).cast("long"), F.lit("failed"),
        F.format_string("%d row(s) of entities that are not configured", "every")))


def readable() -> Column:
    """Whether a batch row parsed and has a date."""
    return (F.col("_bad") == "") & F.col("date").isNotNull()


def rejected(batch: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """(entity, reason, raw) of every row that can never be loaded."""
    configured = entities.select(key, F.lit(True).alias("_configured"))
    reason = (F.when(F.col("_bad") != "", F.col("_bad"))
              .when(F.col("date").isNull(), "no date")
              .when(F.col("_configured").isNull(), "not configured"))
    values = [c for c in batch.columns if c not in ("_bad", "_raw", "ingest_seq")]
    raw = F.coalesce(F.col("_raw"), F.to_json(F.struct(*values)))
    return batch.join(configured, key, "left").select(
        F.col(key).alias("entity"), reason.alias("reason"), raw.alias("raw")).where(
        F.col("reason").isNotNull())


def loadable(batch: DataFrame, audit: DataFrame, key: str, columns: Sequence[str],
             required: str, status: str = "success") -> DataFrame:
    """The parsed, non-null rows of the entities with this status."""
    those = audit.where((F.col("status") == status) & (F.col("ticker") != UNKNOWN)).select(
        F.col("ticker").alias(key))
    return (
        batch.join(those, key, "left_semi")
        .where(readable() & F.col(required).isNotNull())
        .select(*columns)
    )


class LoadError(Exception):
    """Names every entity that failed, after the others were loaded."""


def raise_on_failures(audit: DataFrame, what: str) -> None:
    failed = [r.ticker for r in
              audit.where(F.col("status") == "failed").select("ticker").orderBy("ticker").collect()]
    if failed:
        raise LoadError(f"Load failed for {what}: {', '.join(failed)}")
