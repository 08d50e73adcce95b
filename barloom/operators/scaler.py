"""Standard scaling with population standard deviations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    sds: tuple[float, ...]

    def scaled(self, name: str) -> Column:
        i = self.columns.index(name)
        return (F.col(name) - F.lit(self.means[i])) / F.lit(self.sds[i])

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each column by its scaled value; NULLs stay NULL."""
        return df.withColumns({name: self.scaled(name) for name in self.columns})

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            list(zip(range(len(self.columns)), self.columns, self.means, self.sds)),
            "position int, feature string, mean double, sd double")

    @staticmethod
    def from_frame(df: DataFrame) -> Scaler:
        rows = sorted(df.collect())          # one row per feature
        return Scaler(tuple(r.feature for r in rows), tuple(r["mean"] for r in rows),
                      tuple(r.sd for r in rows))


def scaler_aggregates(columns: Sequence[str]) -> list[Column]:
    """Mean and population sd of every column, for use in one aggregate over train rows."""
    return [agg for c in columns
            for agg in (F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"sd_{c}"))]


def scaler_params(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, feature, mean, sd), one row per feature; a zero sd becomes 1."""
    wide = train.agg(*scaler_aggregates(columns))
    rows = F.array(*(
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"),
                 F.col(f"mean_{c}").alias("mean"),
                 F.when(F.col(f"sd_{c}") == 0, 1.0).otherwise(F.col(f"sd_{c}")).alias("sd"))
        for i, c in enumerate(columns)))
    return wide.select(F.inline(rows))


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    return Scaler.from_frame(scaler_params(train, columns))
