"""Pooled logistic regression on scaled features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Logistic:
    columns: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def margin(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.columns, self.weights):
            total = total + F.lit(weight) * F.col(name)
        return total

    def probability(self) -> Column:
        """P(class 1) from scaled columns, as an expression; NULL if any input is."""
        return 1 / (1 + F.exp(-self.margin()))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        values = [*zip(range(len(self.columns)), self.columns, self.weights),
                  (len(self.columns), "intercept", self.intercept)]
        return spark.createDataFrame(values, "position int, feature string, weight double")

    @classmethod
    def from_frame(cls, df: DataFrame) -> Logistic:
        *rows, last = df.orderBy("position").collect()
        return cls(tuple(r.feature for r in rows), tuple(r.weight for r in rows), last.weight)


def fit_logistic(train: DataFrame, columns: Sequence[str], label: str = "target",
                 strength: float = 1.0, most_steps: int = 50, tolerance: float = 1e-9) -> Logistic:
    """The minimum of the summed loss plus half of `strength` times the squared weights.

    Newton's method: a step is one aggregate, which adds up gradient, Hessian and loss in a
    row of some ninety numbers, and a small linear system on the driver. Steps that raise
    the loss are halved. The intercept is not penalized. The sums are grouped by nothing, so
    a pass shuffles one row a task whatever the size of the table.
    """
    columns = tuple(columns)
    k = len(columns)
    names = [f"_x{i}" for i in range(k + 1)]
    inputs = train.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], F.lit(1.0).alias(names[k]),
                          F.col(label).cast("double").alias("_y"))
    upper = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    penalty = np.full(k + 1, strength)
    penalty[k] = 0.0

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        model = Logistic(tuple(names[:k]), tuple(map(float, w[:k])), float(w[k]))
        p = F.col("_p")
        # log(1 + e^m) - y m, without overflow
        loss = F.greatest("_m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("_m"))) - F.col("_y") * F.col("_m")
        row = (inputs.withColumns({"_m": model.margin(), "_p": model.probability()})
               .withColumns({"_r": F.col("_y") - p, "_v": p * (1 - p)})
               .agg(F.sum(loss), *[F.sum(F.col("_r") * F.col(n)) for n in names],
                    *[F.sum(F.col("_v") * F.col(names[i]) * F.col(names[j])) for i, j in upper]).first())
        if row[0] is None:
            raise ValueError("no training rows")
        gradient = np.array(row[1:k + 2]) - penalty * w
        hessian = np.diag(penalty)
        for (i, j), value in zip(upper, row[k + 2:]):
            hessian[i, j] += value
            hessian[j, i] = hessian[i, j]
        return row[0] + 0.5 * (penalty * w * w).sum(), gradient, hessian

    w = np.zeros(k + 1)
    loss, gradient, hessian = at(w)
    for _ in range(most_steps):
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        while True:
            there = at(w + step)
            if there[0] <= loss * (1 + 1e-12) + 1e-12 or np.abs(step).max() < tolerance:
                break
            step /= 2
        w = w + step
        loss, gradient, hessian = there
        if np.abs(step).max() < tolerance:
            break
    return Logistic(columns, tuple(map(float, w[:k])), float(w[k]))


def feature_weights(spark: SparkSession, model: Logistic) -> DataFrame:
    """Weights by name, largest magnitude first."""
    return (
        spark.createDataFrame(list(zip(model.columns, model.weights)),
                              "feature string, weight double")
        .orderBy(F.abs("weight").desc(), "feature")
    )


def predicted_class(probability: Column) -> Column:
    """Class 1 above one half."""
    return F.when(probability > 0.5, 1).when(probability.isNotNull(), 0)


def direction(probability: Column) -> Column:
    """`up` from one half on, else `down`."""
    return F.when(probability >= 0.5, "up").when(probability.isNotNull(), "down")
