"""Isolation forest (Liu, Ting and Zhou 2008) on Spark.

Trees need few rows each, so fitting is a keyed sample followed by one bounded group per
tree. All draws are MD5 digests of a text that names what is drawn, read as fractions: the
forest depends on the data and the seed only, and any engine can draw the same numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NODE_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, "
               "left_id int, right_id int, path_length double")
_DIGITS = 13                      # hexadecimal digits that a double holds


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _share(*inputs: Column) -> Column:
    """A uniform number in [0, 1) from the inputs, written as text with colons between."""
    text = F.concat_ws(":", *[c.cast("string") for c in inputs])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double") / F.lit(16.0 ** _DIGITS)


def tree_samples(train: DataFrame, columns: Sequence[str], key: Sequence[str], n_rows: int,
                 trees: int, tree_rows: int, seed: int) -> DataFrame:
    """`tree_rows` distinct rows for every tree, drawn from the whole table by hashes.

    A row is offered to so many trees that each tree is offered about three times the rows
    it needs; the trees follow one another from one that the row's hash names, so they
    differ. The ranking that makes the number exact works on groups of that size.
    """
    keys = [F.col(c) for c in key]
    offered = trees * min(1.0, 3.0 * tree_rows / n_rows)         # trees a row, on average
    draws = math.ceil(offered)
    first = F.floor(_share(F.lit(seed), F.lit("first"), *keys) * trees)
    drawn = (
        train.select(*key, *columns, first.alias("_first"),
                     F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("_step"))
        .withColumn("tree_id", F.pmod(F.col("_first") + F.col("_step"), F.lit(trees)).cast("int"))
        .where(_share(F.lit(seed), F.lit("offer"), F.col("tree_id"), *keys) < offered / draws)
        .withColumn("_draw", _share(F.lit(seed), F.lit("draw"), F.col("tree_id"), *keys))
        .drop("_first", "_step")
        # AQE would pack samples this small into one task, but the work is in the building.
        .repartition(min(trees, train.sparkSession.sparkContext.defaultParallelism), "tree_id")
    )
    by_draw = Window.partitionBy("tree_id").orderBy("_draw", *key)
    return (drawn.withColumn("_n", F.row_number().over(by_draw))
            .where(F.col("_n") <= tree_rows).drop("_n", "_draw"))


def fit_forest(train: DataFrame, columns: Sequence[str], key: Sequence[str], n_rows: int,
               trees: int = 100, tree_rows: int = 256, seed: int = 42) -> DataFrame:
    """The forest as a node table. A leaf has feature -1 and its path length.

    The root is node 0, the children of node i are 2 i + 1 and 2 i + 2.
    """
    columns, key = list(columns), list(key)
    size = min(tree_rows, n_rows)
    depth_limit = math.ceil(math.log2(max(size, 2)))
    # The functions below travel to the executors by value: they use nothing of this
    # package, which need not be installed there.
    leaf_paths = [average_path(rest) for rest in range(size + 1)]
    names = [field.split()[0] for field in NODE_SCHEMA.split(", ")]
    digits = _DIGITS

    def share(*inputs: object) -> float:
        digest = hashlib.md5(":".join(map(str, inputs)).encode(), usedforsecurity=False).hexdigest()
        return int(digest[:digits], 16) / 16.0 ** digits

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(rows["tree_id"].iloc[0])
        x = rows[columns].to_numpy(dtype=float)
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        while todo:
            node_id, members, depth = todo.pop()
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(members) <= 1 or not len(splittable):
                nodes.append((tree_id, node_id, -1, 0.0, -1, -1,
                              depth + leaf_paths[len(members)]))
                continue
            feature = int(splittable[int(share(seed, tree_id, node_id, "feature") * len(splittable))])
            span = high[feature] - low[feature]
            threshold = float(low[feature] + share(seed, tree_id, node_id, "threshold") * span)
            goes_left = x[members, feature] <= threshold
            left, right = 2 * node_id + 1, 2 * node_id + 2
            nodes.append((tree_id, node_id, feature, threshold, left, right, 0.0))
            todo.append((left, members[goes_left], depth + 1))
            todo.append((right, members[~goes_left], depth + 1))
        return pd.DataFrame(nodes, columns=names)

    samples = tree_samples(train, columns, key, n_rows, trees, size, seed)
    return samples.groupBy("tree_id").applyInPandas(build, NODE_SCHEMA)


class ForestScorer:
    """Scores rows against broadcast node arrays: at most trees x (2 x tree_rows - 1) nodes."""

    def __init__(self, nodes: DataFrame, train_rows: int, tree_rows: int = 256):
        table = nodes.toPandas().sort_values(["tree_id", "node_id"])
        trees = []
        for _, t in table.groupby("tree_id"):
            place = pd.Series(np.arange(len(t)), index=t["node_id"])    # node ids have gaps
            trees.append((t["feature"].to_numpy(), t["threshold"].to_numpy(),
                          place.reindex(t["left_id"]).to_numpy(), place.reindex(t["right_id"]).to_numpy(),
                          t["path_length"].to_numpy()))
        trees = [(f, v, np.nan_to_num(a).astype(np.int64), np.nan_to_num(b).astype(np.int64), p)
                 for f, v, a, b, p in trees]
        normal = average_path(min(tree_rows, train_rows))
        shared = nodes.sparkSession.sparkContext.broadcast(trees)

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                x = batch.to_numpy(dtype=float)
                rows, total = np.arange(len(x)), np.zeros(len(x))
                for feature, threshold, left, right, path in shared.value:
                    at = np.zeros(len(x), dtype=np.int64)
                    inner = feature[at] >= 0
                    while inner.any():
                        goes_left = x[rows, feature[at]] <= threshold[at]
                        at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
                        inner = feature[at] >= 0
                    total += path[at]
                yield pd.Series(np.exp2(-total / len(shared.value) / normal))

        self._score = score

    def score(self, inputs: Mapping[str, Column]) -> Column:
        """Anomaly score in (0, 1), from the scaled inputs in fit order; NULL if any is."""
        complete = F.lit(True)
        for value in inputs.values():
            complete = complete & value.isNotNull()
        packed = F.struct(*(value.alias(name) for name, value in inputs.items()))
        return F.when(complete, self._score(packed))
