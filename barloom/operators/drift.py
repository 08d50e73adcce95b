"""Two-sample drift of every feature between a reference and a current window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .distribution import cumulative_counts

# Flag limits of the two tests, the floor of the distance's divisor, and
# the reference size above which the automatic choice leaves the KS test.
KS_P_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
MIN_SPREAD = 0.001
KS_MAX_ROWS = 1000


def in_reference(cutoff: date) -> Column:
    return F.col("date") < F.lit(cutoff)


def in_current(as_of: date, days: int) -> Column:
    return F.col("date") >= F.date_sub(F.lit(as_of), days)


def window_counts(features: DataFrame, cutoff: date, as_of: date, days: int) -> DataFrame:
    """Rows of both windows, in one pass."""
    return features.agg(F.count_if(in_reference(cutoff)).alias("reference_rows"),
                        F.count_if(in_current(as_of, days)).alias("current_rows"))


def value_counts(features: DataFrame, columns: Sequence[str], cutoff: date, as_of: date,
                 days: int) -> DataFrame:
    """(feature, value, n_ref, n_cur) without NULLs: the two samples as counts."""
    ref, cur = in_reference(cutoff), in_current(as_of, days)
    return (
        features.where(ref | cur)
        .select(ref.cast("int").alias("is_ref"), cur.cast("int").alias("is_cur"), *columns)
        .unpivot(["is_ref", "is_cur"], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.sum("is_ref").alias("n_ref"), F.sum("is_cur").alias("n_cur"))
    )


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value 2 sum (-1)^(k-1) exp(-2 k^2 L^2), L = d sqrt(nm/(n+m)).

    Below L = 0.2 the p-value differs from 1 by less than 1e-11, and the alternating sum
    would need more terms.
    """
    scale = d * F.sqrt(n * m / (n + m))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k * k * scale * scale))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * terms))
    return F.when(scale < 0.2, 1.0).when(scale.isNotNull(), bounded)


def drift_statistics(features: DataFrame, columns: Sequence[str], cutoff: date, as_of: date,
                     days: int) -> DataFrame:
    """Per feature: sample sizes, KS statistic and p-value, normed Wasserstein distance.

    Both tests compare the same two empirical distributions F and G: KS takes the largest
    |F - G|, Wasserstein the area between them.
    """
    counts = materialize(value_counts(features, columns, cutoff, as_of, days), "value_counts")
    # One row per feature: sample sizes and moments of the reference sample.
    sizes = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("n"), F.sum("n_cur").alias("m"),
        F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("ref_mean"))
    ranked = cumulative_counts(counts, "feature", "value", ["n_ref", "n_cur"])
    gap = F.abs(F.try_divide("cum_n_ref", "n") - F.try_divide("cum_n_cur", "m"))
    centred = F.col("value") - F.col("ref_mean")
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    spread = F.greatest(F.sqrt(F.try_divide("square_sum", "n")), F.lit(MIN_SPREAD))
    return (
        ranked.join(F.broadcast(sizes), "feature")
        .groupBy("feature", "n", "m")
        .agg(F.max(gap).alias("ks"), F.sum(gap * width).alias("area"),
             F.sum(centred * centred * F.col("n_ref")).alias("square_sum"))
        .select(
            "feature", F.col("n").alias("reference_rows"), F.col("m").alias("current_rows"),
            F.col("ks").alias("ks_statistic"),
            ks_p_value(F.col("ks"), F.col("n"), F.col("m")).alias("ks_p_value"),
            F.try_divide("area", spread).alias("distance"))
    )


def drift_report(statistics: DataFrame, method: str = "ks") -> DataFrame:
    """(feature, score, drift_detected) under `ks`, `wasserstein`, or `auto`, which takes
    the distance for reference samples above KS_MAX_ROWS. An empty sample has no score."""
    by_p = F.col("ks_p_value") < KS_P_LIMIT
    by_distance = F.col("distance") >= DISTANCE_LIMIT
    use_ks = {"ks": F.lit(True), "wasserstein": F.lit(False),
              "auto": F.col("reference_rows") <= KS_MAX_ROWS}[method]
    return statistics.select(
        "feature", "reference_rows", "current_rows",
        F.when(use_ks, F.col("ks_p_value")).otherwise(F.col("distance")).alias("score"),
        F.coalesce(F.when(use_ks, by_p).otherwise(by_distance), F.lit(False)).alias("drift_detected"))


def drift_summary(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if("drift_detected").alias("drifted"), F.count("*").alias("tested"))
