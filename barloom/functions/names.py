"""Column names of downloaded frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def flatten_columns(df: DataFrame, separator: str = "|") -> DataFrame:
    """Keep the first level of two-level names: `Open|X` becomes `Open`."""
    return df.toDF(*(name.split(separator)[0] for name in df.columns))


def snake_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with spaces as underscores."""
    return df.toDF(*(name.lower().replace(" ", "_") for name in df.columns))


def normalize_columns(df: DataFrame, separator: str = "|") -> DataFrame:
    return snake_columns(flatten_columns(df, separator))
