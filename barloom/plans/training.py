"""Dataset, temporal split, model fit, evaluation and saved artifacts."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distribution import exact_quantile
from ..operators.iforest import ForestScorer, fit_forest
from ..operators.logistic import Logistic, fit_logistic, predicted_class
from ..operators.metrics import evaluation_record
from ..operators.scaler import Scaler, scaler_aggregates
from ..session import materialize
from ..settings import FEATURE_COLS, Settings
from ..sources.store import Store

KEY = ["ticker", "date"]


def training_rows(features: DataFrame) -> DataFrame:
    """Labelled rows with all eleven features."""
    return (features.select(*KEY, *FEATURE_COLS, "target")
            .dropna(how="any", subset=[*FEATURE_COLS, "target"]))


def is_train(settings: Settings) -> Column:
    return F.col("date") < F.lit(settings.cutoff)


def with_split(rows: DataFrame, settings: Settings) -> DataFrame:
    """Older rows train, newer rows test; nothing is shuffled between them."""
    return rows.withColumn("split", F.when(is_train(settings), "train").otherwise("test"))


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    train_rows: int
    tree_rows: int
    threshold: float     # scores above it are anomalies

    def scorer(self) -> ForestScorer:
        return ForestScorer(self.nodes, self.train_rows, self.tree_rows)


@dataclass(frozen=True)
class Model:
    """What serving needs. A part is None when its artifact is missing."""
    scaler: Scaler | None
    logistic: Logistic | None
    forest: Forest | None
    train_date: str | None = None
    n_train: int = 0
    n_test: int = 0
    majority: int | None = None


def train(rows: DataFrame, settings: Settings) -> Model:
    """Fit scaler, logistic regression and isolation forest on the train rows.

    `rows` is read several times (one aggregate, the optimizer's passes, the tree
    samples, the threshold), so pass a stored table.
    """
    mine = is_train(settings)
    train_only = rows.select(mine.alias("is_train"), *(
        F.when(mine, F.col(c)).alias(c) for c in (*FEATURE_COLS, "target")))
    facts = train_only.agg(
        F.count_if("is_train").alias("n"), F.count_if(~F.col("is_train")).alias("n_test"),
        F.sum("target").alias("ones"), *scaler_aggregates(FEATURE_COLS)).first()
    n = facts["n"]
    if not n:
        raise ValueError("no training rows before the cutoff")
    scaler = Scaler(FEATURE_COLS, tuple(facts[f"mean_{c}"] for c in FEATURE_COLS),
                    tuple(facts[f"sd_{c}"] or 1.0 for c in FEATURE_COLS))
    scaled = scaler.transform(rows.where(mine))

    logistic = fit_logistic(scaled, FEATURE_COLS)
    forest = train_forest(scaled, n, settings)
    return Model(scaler, logistic, forest,
                 datetime.now(timezone.utc).isoformat(), n, facts["n_test"],
                 int(2 * facts["ones"] > n))


def train_forest(scaled: DataFrame, n: int, settings: Settings) -> Forest:
    nodes = materialize(
        fit_forest(scaled, FEATURE_COLS, KEY, n, settings.trees, settings.tree_rows,
                   settings.seed), "forest")
    forest = Forest(nodes, n, settings.tree_rows, 1.0)
    scores = materialize(
        scaled.select(forest.scorer().score({c: F.col(c) for c in FEATURE_COLS}).alias("score"))
        .groupBy("score").agg(F.count("*").alias("n")), "train_scores")
    return replace(forest, threshold=exact_quantile(scores, "score", 1 - settings.contamination))


def with_prediction(rows: DataFrame, model: Model) -> DataFrame:
    """Add probability_up and prediction to rows with raw features."""
    scaled = {f"_scaled_{c}": model.scaler.scaled(c) for c in FEATURE_COLS}
    on_scaled = replace(model.logistic, columns=tuple(scaled))
    return (
        rows.withColumns(scaled)
        .withColumn("probability_up", on_scaled.probability())
        .withColumn("prediction", predicted_class(F.col("probability_up")))
        .drop(*scaled)
    )


def with_anomaly(rows: DataFrame, model: Model) -> DataFrame:
    """Add anomaly_score and is_anomaly to rows with raw features."""
    scaled = {c: model.scaler.scaled(c) for c in FEATURE_COLS}
    return (
        rows.withColumn("anomaly_score", model.forest.scorer().score(scaled))
        .withColumn("is_anomaly", F.col("anomaly_score") > model.forest.threshold)
    )


def evaluate(rows: DataFrame, model: Model, settings: Settings) -> DataFrame:
    """The six test-set metrics in one row, from one pass over the scored test rows."""
    test = rows.where(~is_train(settings))
    return evaluation_record(with_anomaly(with_prediction(test, model), model), model.majority)


def anomaly_sample(scored: DataFrame, n: int = 10) -> DataFrame:
    """The first n anomalies in (ticker, date) order."""
    return scored.where("is_anomaly").orderBy(*KEY).limit(n).select(*KEY)


def save_model(store: Store, model: Model, settings: Settings) -> None:
    spark = store.spark
    model.scaler.to_frame(spark).coalesce(1).write.mode("overwrite").json(store.path("scaler"))
    model.logistic.to_frame(spark).coalesce(1).write.mode("overwrite").json(store.path("logistic"))
    model.forest.nodes.write.mode("overwrite").parquet(store.path("forest/nodes"))
    spark.createDataFrame(
        [(model.forest.train_rows, model.forest.tree_rows, model.forest.threshold)],
        "train_rows long, tree_rows int, threshold double",
    ).coalesce(1).write.mode("overwrite").json(store.path("forest/params"))
    store.write_metadata(
        "trained", train_date=model.train_date, train_cutoff_date=settings.cutoff.isoformat(),
        feature_cols=list(FEATURE_COLS), n_train_rows=model.n_train, n_test_rows=model.n_test,
        majority_class=model.majority)


def save_evaluation(store: Store, record: DataFrame) -> None:
    """Merge the six metrics into the metadata document."""
    metrics = record.first().asDict()
    metrics.pop("n_rows")
    store.update_metadata("trained", "evaluated", **metrics)


def _present(load):
    """The artifact, or None when its folder is missing."""
    try:
        return load()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return None
        raise


def load_metadata(store: Store):
    """The newest metadata document as a row, or None."""
    for stage in ("evaluated", "trained"):
        row = _present(lambda s=stage: store.read_metadata(s).first())
        if row is not None:
            return row
    return None


def load_model(store: Store) -> Model:
    """Read the artifacts; a missing one leaves its part None instead of failing."""
    spark: SparkSession = store.spark
    scaler = _present(lambda: Scaler.from_frame(spark.read.schema(
        "position int, feature string, mean double, sd double").json(store.path("scaler"))))
    logistic = _present(lambda: Logistic.from_frame(spark.read.schema(
        "position int, feature string, weight double").json(store.path("logistic"))))
    params = _present(lambda: spark.read.schema(
        "train_rows long, tree_rows int, threshold double").json(store.path("forest/params")).first())
    nodes = _present(lambda: spark.read.parquet(store.path("forest/nodes")))
    forest = None
    if params is not None and nodes is not None:
        forest = Forest(nodes, params.train_rows, params.tree_rows, params.threshold)
    meta = load_metadata(store)
    return Model(
        scaler, logistic, forest, meta.train_date if meta else None, meta.n_train_rows if meta else 0,
        meta.n_test_rows if meta else 0, meta.majority_class if meta else None)
