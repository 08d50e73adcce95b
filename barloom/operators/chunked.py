"""Window transforms over pieces of a long series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_chunks(df: DataFrame, key: str, order: str, chunk_rows: int,
              lookback: int, lookahead: int,
              transform: Callable[[DataFrame, Sequence[str]], DataFrame],
              slice_days: int = 366) -> DataFrame:
    """Apply a window transform to chunks of `chunk_rows` rows per key.

    Each chunk also receives the `lookback` rows before it and the `lookahead` rows after
    it; they feed the frames and are dropped at the end. `transform` gets the frame and
    the columns to partition its windows by, and must keep the columns it is given.

    A row's place in its key comes from the row counts of earlier calendar slices plus
    its place within its own slice, so no step sees a whole key at once. The ranked rows
    are already partitioned and sorted for the merge join with those counts, which moves
    only the counts.
    """
    if chunk_rows <= max(lookback, lookahead):
        raise ValueError("a chunk must be longer than the rows it lends to its neighbours")
    sliced = df.withColumn("_slice", F.floor(F.unix_date(order) / slice_days))
    before = (Window.partitionBy(key).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        sliced.groupBy(key, "_slice").agg(F.count("*").alias("_n"))
        .select(key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    in_slice = Window.partitionBy(key, "_slice").orderBy(order)
    placed = (
        sliced.withColumn("_rank", F.row_number().over(in_slice))
        .join(offsets.hint("merge"), [key, "_slice"])
        .withColumn("_place", F.col("_before") + F.col("_rank") - 1)
        .withColumn("_home", F.floor(F.col("_place") / chunk_rows))
        .drop("_slice", "_rank", "_before")
    )
    within = F.col("_place") % chunk_rows
    copies = F.array_compact(F.array(
        F.col("_home"),
        F.when(within >= chunk_rows - lookback, F.col("_home") + 1),
        F.when((within < lookahead) & (F.col("_home") > 0), F.col("_home") - 1),
    ))
    # Partitioned by chunk outright: a partitioning by key alone would also satisfy the
    # windows, and would put a long series back into one task.
    spread = (placed.withColumn("_chunk", F.explode(copies)).drop("_place")
              .repartition(key, "_chunk"))
    return (
        transform(spread, (key, "_chunk"))
        .where(F.col("_chunk") == F.col("_home")).drop("_chunk", "_home")
    )
