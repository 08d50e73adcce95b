"""Insert-if-absent loads and their watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def first_per_key(batch: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row with the lowest `seq` of each key.

    An aggregate rather than a ranking: copies of one key collapse before the shuffle,
    so a key repeated any number of times still costs one row per task. `seq` must be
    unique within a key for the result to be defined.
    """
    rest = [c for c in batch.columns if c not in (*keys, seq)]
    return batch.groupBy(*keys).agg(*(F.min_by(c, seq).alias(c) for c in rest))


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: Sequence[str],
                     seq: str) -> DataFrame:
    """The batch rows to append: first per key, and only keys that `existing` lacks.

    The stored table is first cut to the keys of the batch. With a small batch that is a
    broadcast semi join, which reads the stored keys without shuffling them.
    """
    keys = list(keys)
    fresh = first_per_key(batch, keys, seq)
    taken = existing.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return fresh.join(taken, keys, "left_anti")


def load_watermark(marks: DataFrame, entities: DataFrame, key: str, as_of: date,
                   lookback_years: int) -> DataFrame:
    """Per configured entity: its newest stored date, or today less the lookback, and the
    day after, from which the next load starts.

    `marks` has a row (key, newest) for each key of the table, as the store keeps them.
    """
    first_load = F.date_sub(F.lit(as_of), 365 * lookback_years)
    return (
        entities.join(marks, key, "left")
        .select(key, F.coalesce("newest", first_load).alias("last_date"))
        .withColumn("next_start", F.date_add("last_date", 1))
    )


def after_watermark(batch: DataFrame, watermark: DataFrame, key: str,
                    end: date | None = None) -> DataFrame:
    """Rows dated on or after their entity's next start, and before `end` if that is given.

    Rows without a date or of entities that are not configured stay in, for the audit to
    report.
    """
    day = F.col("date")
    inside = day >= F.col("next_start")
    if end is not None:
        inside = inside & (day < F.lit(end))
    return (
        batch.join(watermark.select(key, "next_start"), key, "left")
        .where(day.isNull() | F.col("next_start").isNull() | inside)
        .drop("next_start")
    )
