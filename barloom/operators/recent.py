"""Newest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str = "ticker", order: str = "date") -> DataFrame:
    """The newest row of each key, as an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(
        F.max(order).alias(order), *(F.max_by(c, order).alias(c) for c in rest)
    ).select(*df.columns)


def last_rows_per_key(df: DataFrame, n: int, key: str = "ticker",
                      order: str = "date") -> DataFrame:
    """The newest n rows of each key. Spark applies the limit in each task before the
    shuffle (WindowGroupLimit), so a key sends at most n rows per task."""
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (df.withColumn("_n", F.row_number().over(newest_first))
            .where(F.col("_n") <= n).drop("_n"))
