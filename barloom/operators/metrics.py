"""Classification metrics as single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names that readers of the metadata expect.
METRICS = ("lr_accuracy", "lr_precision", "lr_recall", "lr_f1")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _counts(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return [F.count("*").alias("n"), F.count_if(F.col(label) == F.col(prediction)).alias("hit"),
            F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")]


def _metrics(digits: int) -> list[Column]:
    """The columns of METRICS from the counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratios = (_ratio(F.col("hit"), F.col("n")), _ratio(tp, tp + fp), _ratio(tp, tp + fn),
              _ratio(2 * tp, 2 * tp + fp + fn))
    return [F.round(r, digits).alias(name) for r, name in zip(ratios, METRICS)]


def classification_metrics(df: DataFrame, label: str = "target",
                           prediction: str = "prediction", digits: int = 4) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 in one row; undefined ratios are 0."""
    return df.agg(*_counts(label, prediction)).select(F.col("n").alias("n_rows"), *_metrics(digits))


def majority_class(df: DataFrame, label: str = "target") -> DataFrame:
    """The most frequent label, the lowest on a tie, and its count."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(
        F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label))).alias("majority_class"),
        F.max("n").alias("n_rows"))


def baseline_accuracy(train: DataFrame, test: DataFrame, label: str = "target",
                      digits: int = 4) -> DataFrame:
    """Share of test labels equal to the train majority. Both sides are reduced to label
    counts before they meet."""
    majority = majority_class(train, label).select("majority_class")
    counts = test.groupBy(label).agg(F.count("*").alias("n"))
    return (
        counts.withColumn("hit", F.col(label) == majority.scalar())
        .agg(F.sum("n").alias("n_rows"),
             F.round(_ratio(F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)), F.sum("n")),
                     digits).alias("baseline_accuracy"))
    )


def evaluation_record(scored: DataFrame, majority: int, label: str = "target",
                      digits: int = 4) -> DataFrame:
    """The four metrics, the baseline's accuracy and the anomaly rate, in one aggregate.

    `scored` has columns prediction and is_anomaly.
    """
    n = F.col("n")
    rates = {                      # fixed names
        "baseline_accuracy": _ratio(F.col("base"), n), "iso_anomaly_rate": _ratio(F.col("odd"), n)}
    counts = scored.agg(
        *_counts(label, "prediction"), F.count_if(F.col(label) == majority).alias("base"),
        F.count_if("is_anomaly").alias("odd"))
    return counts.select(n.alias("n_rows"), *_metrics(digits),
                         *(F.round(r, digits).alias(name) for name, r in rates.items()))
