"""Exact cumulative counts and order statistics without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def cumulative_counts(values: DataFrame, group: str, value: str, counts: Sequence[str]) -> DataFrame:
    """Running totals of `counts` in value order within each group, and the next value.

    Takes one row per (group, value). The rows are partitioned by range, in as many
    partitions as a shuffle has, and written once with the partition's number; a partition
    sums its own rows of a group and adds the totals of the partitions before it. The table
    of totals has one row per group and partition.
    """
    ranged = materialize(
        values.select(group, value, *counts).repartitionByRange(group, value)
        .withColumn("_part", F.spark_partition_id()), "ranged")
    across = Window.partitionBy(group).orderBy("_part")
    below = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "_part")
        .agg(*(F.sum(c).alias(f"_sum_{c}") for c in counts), F.min(value).alias("_lowest"))
        .select(group, "_part",
                *(F.coalesce(F.sum(f"_sum_{c}").over(below), F.lit(0)).alias(f"_below_{c}")
                  for c in counts),
                F.lead("_lowest").over(across).alias("_next_lowest"))
    )
    inside = Window.partitionBy(group, "_part").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(offsets, [group, "_part"]).select(
        group, value, *counts,
        *((F.col(f"_below_{c}") + F.sum(c).over(running)).alias(f"cum_{c}") for c in counts),
        F.coalesce(F.lead(value).over(inside), F.col("_next_lowest")).alias("next_value"),
    )


def exact_quantile(values: DataFrame, value: str, q: float) -> float | None:
    """The q-quantile with linear interpolation, as a number on the driver.

    Takes one row per distinct value and its count in column `n`. The driver sees the two
    values whose ranks are asked for.
    """
    total = values.agg(F.sum("n")).first()[0]
    if not total:
        return None
    place = q * (total - 1)
    low = int(place)
    high = min(low + 1, total - 1)
    upto = F.col("cum_n")
    hits = (
        cumulative_counts(values.withColumn("_all", F.lit(0)), "_all", value, ["n"])
        .where((upto - F.col("n") <= high) & (upto > low))
        .select(value).orderBy(value).collect()
    )
    lowest, highest = hits[0][0], hits[-1][0]
    return lowest + (highest - lowest) * (place - low)
