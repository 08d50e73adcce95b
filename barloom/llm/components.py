"""Connected components by contraction, in Spark joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); nodes of one component share the root.

    Each round every node moves to the best node among itself and its neighbours, and the
    edges are redrawn between what is left. Best is the smallest id in even rounds, which
    folds a star whose centre is smallest at once, and the smallest hash in odd ones, which
    shortens any path by a share. The table is written each round, so lineage stays short.
    """
    edges = materialize(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn(
        "root", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        order = (lambda c, t=turn: F.xxhash64(c, F.lit(t)) if t % 2 else F.col(c))
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(order("b").alias("o"), F.col("b").alias("p"))).alias("m"))
        moves = materialize(best.select(F.col("a").alias("root"), F.when(
            F.struct(order("a").alias("o"), F.col("a").alias("p")) < F.col("m"), F.col("a"))
            .otherwise(F.col("m.p")).alias("to")).where("root <> to"), "moves")
        labels = materialize(
            labels.join(moves, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
            "labels")
        step = edges
        for end in ("a", "b"):
            step = step.join(moves.withColumnRenamed("root", end), end, "left").withColumn(
                end, F.coalesce("to", end)).drop("to")
        edges = materialize(step.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        turn += 1
    return labels
