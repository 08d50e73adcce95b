"""Scaling, regression, forest, metrics, drift and scoring."""

import os
import subprocess
import sys
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from barloom.operators import drift as D
from barloom.operators import iforest as I
from barloom.operators import metrics as M
from barloom.operators.distribution import cumulative_counts, exact_quantile
from barloom.operators.logistic import Logistic, feature_weights, fit_logistic
from barloom.operators.recent import last_rows_per_key, latest_per_key
from barloom.operators.scaler import Scaler, fit_scaler
from barloom.plans import scoring as V
from barloom.plans import training as R
from barloom.plans.ingest import entity_frame
from barloom.settings import FEATURE_COLS, Settings
from barloom.sources.store import Store

SETTINGS = Settings(as_of=date(2021, 1, 31), cutoff=date(2020, 7, 1), tickers=("A", "B"), trees=25)


@pytest.fixture(scope="module")
def spark(spark):
    """A session without observed metrics: a library model holds the one it was fitted in, and once
    a store has counted NULLs there Spark cannot serialize it."""
    return spark.newSession()


def feature_rows(spark, n=300, seed=3):
    """Two tickers with random features; the label leans on two of them."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(FEATURE_COLS)))
    y = (x[:, 0] - 0.5 * x[:, 5] + rng.normal(size=n) > 0).astype(int)
    data = [("AB"[i % 2], date(2020, 1, 1) + timedelta(days=i), *map(float, x[i]), int(y[i]))
            for i in range(n)]
    names = ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(data, f"ticker string, date date, {names}, target int"), x, y


@pytest.fixture(scope="module")
def trained(spark):
    df, x, y = feature_rows(spark)
    return df, R.train(df, SETTINGS), x, y


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ("a", "b"))
    assert scaler.means == pytest.approx((7 / 3, 5.0))
    assert scaler.sds == pytest.approx((np.std([1, 2, 4]), 1.0))
    assert [r.b for r in scaler.transform(df).collect()] == [0.0] * 3
    assert Scaler.from_frame(scaler.to_frame(spark)) == scaler


def test_regression_reaches_the_optimum(spark):
    df, x, y = feature_rows(spark)
    model = fit_logistic(df, FEATURE_COLS)
    w = np.zeros(x.shape[1] + 1)
    full = np.column_stack([x, np.ones(len(y))])
    keep = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-full @ w))
        w -= np.linalg.solve(full.T @ (full * (p * (1 - p))[:, None]) + keep, full.T @ (p - y) + keep @ w)
    np.testing.assert_allclose([*model.weights, model.intercept], w, atol=1e-9)
    assert Logistic.from_frame(model.to_frame(spark)) == model
    ranked = [r.feature for r in feature_weights(spark, model).collect()]
    assert ranked[0] == "return_1d" and len(ranked) == len(FEATURE_COLS)


def test_regression_equals_the_library(spark, trained):
    df, model, *_ = trained
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    scaled = model.scaler.transform(df).withColumn("target", F.col("target").cast("double"))
    vectors = VectorAssembler(inputCols=list(FEATURE_COLS), outputCol="features").transform(scaled)
    train = vectors.where(R.is_train(SETTINGS))
    library = LogisticRegression(labelCol="target", regParam=1.0 / train.count(), standardization=False,
                                 maxIter=1000, tol=1e-12).fit(train)
    ours = R.with_prediction(df, model).select("date", "probability_up", F.col("prediction").alias("ours"))
    theirs = library.transform(vectors).select(
        "date", vector_to_array("probability")[1].alias("p"), "prediction")
    gap = ours.join(theirs, "date").agg(F.max(F.abs(F.col("p") - F.col("probability_up"))),
                                        F.count_if(F.col("ours") != F.col("prediction"))).first()
    assert gap[0] < 1e-5 and gap[1] == 0


def test_regression_on_separable_and_equal_columns(spark):
    df = spark.createDataFrame([(float(i), float(i), 1e9 * i, int(i > 4)) for i in range(10)],
                               "a double, b double, c double, y int")
    model = fit_logistic(df.withColumn("c", F.col("c") / 1e9), ["a", "b", "c"], label="y")
    assert model.weights[0] == pytest.approx(model.weights[1]) and 0 < model.weights[0] < 10
    far = fit_logistic(df, ["c"], label="y")
    assert far.weights[0] > 0 and np.isfinite(far.intercept)
    with pytest.raises(ValueError):
        fit_logistic(df.where("false"), ["a"], label="y")


def test_facts_of_the_training_run(trained):
    df, model, x, y = trained
    days = [date(2020, 1, 1) + timedelta(days=i) for i in range(len(y))]
    train = np.array([d < SETTINGS.cutoff for d in days])
    assert (model.n_train, model.n_test) == (train.sum(), (~train).sum())
    assert model.majority == int(y[train].sum() * 2 > train.sum())
    np.testing.assert_allclose(model.scaler.sds, x[train].std(axis=0))


def forest_data(spark, n=3000, parts=4):
    rng = np.random.default_rng(0)
    data = [(i, *map(float, rng.normal(size=2))) for i in range(n)]
    data += [(n + j, 8.0 + j, -9.0) for j in range(5)]
    return spark.createDataFrame(data, "id long, a double, b double").repartition(parts)


def nodes_of(forest):
    return rows(forest)


def test_forest_does_not_depend_on_partitions(spark):
    n = 3005
    one, many = (I.fit_forest(forest_data(spark, parts=p), ["a", "b"], ["id"], n, trees=10)
                 for p in (1, 7))
    assert nodes_of(one) == nodes_of(many)
    other = I.fit_forest(forest_data(spark), ["a", "b"], ["id"], n, trees=10, seed=1)
    assert nodes_of(one) != nodes_of(other)


def test_every_tree_has_its_rows(spark):
    sample = I.tree_samples(forest_data(spark), ["a", "b"], ["id"], 3005, 10, 256, 42)
    per_tree = sample.groupBy("tree_id").agg(F.count("*"), F.count_distinct("id")).collect()
    assert len(per_tree) == 10 and all(r[1] == r[2] == 256 for r in per_tree)
    small = forest_data(spark).where("id < 100")
    sample = I.tree_samples(small, ["a", "b"], ["id"], 100, 4, 100, 42)
    assert sample.count() == 400


def test_forest_ranks_planted_outliers_first(spark):
    df = forest_data(spark)
    nodes = I.fit_forest(df, ["a", "b"], ["id"], 3005, trees=50).cache()
    scorer = I.ForestScorer(nodes, 3005)
    scored = df.withColumn("s", scorer.score({"a": F.col("a"), "b": F.col("b")}))
    top = {r.id for r in scored.orderBy(F.desc("s")).limit(5).collect()}
    assert top == set(range(3000, 3005))
    check = scored.limit(20).collect()
    table = {(r.tree_id, r.node_id): r for r in nodes.collect()}
    for row in check:                      # walk each tree by hand
        total = 0.0
        for tree in range(50):
            node = table[tree, 0]
            while node.feature >= 0:
                down = node.left_id if row[1 + node.feature] <= node.threshold else node.right_id
                node = table[tree, down]
            total += node.path_length
        assert row.s == pytest.approx(2 ** (-total / 50 / I.average_path(256)))


def test_forest_score_of_missing_input_is_null(spark):
    df = forest_data(spark)
    scorer = I.ForestScorer(I.fit_forest(df, ["a", "b"], ["id"], 3005, trees=5), 3005)
    gap = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    scores = [r.s for r in gap.select(scorer.score({"a": F.col("a"), "b": F.col("b")}).alias("s")).collect()]
    assert scores[0] is None and 0 < scores[1] < 1


def test_executors_need_not_have_the_package(tmp_path):
    """Only the driver's sys.path names the repository; workers start in another folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from barloom.operators.iforest import ForestScorer, fit_forest
from barloom.session import local_session
spark = local_session(2, partitions=2)
df = spark.range(500).withColumn("a", F.rand(1)).withColumn("b", F.rand(2))
scorer = ForestScorer(fit_forest(df, ["a", "b"], ["id"], 500, trees=3), 500)
print("scored", df.select(scorer.score({{"a": F.col("a"), "b": F.col("b")}}).alias("s")).dropna().count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=300)
    assert "scored 500" in done.stdout, done.stderr[-2000:]


def test_flagged_share_of_training_rows(spark, trained):
    df, model, *_ = trained
    train = df.where(R.is_train(SETTINGS))
    rate = R.with_anomaly(train, model).agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    assert rate == pytest.approx(0.05, abs=0.01)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, q):
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=777), rng.integers(0, 5, 400).astype(float), np.array([3.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "v double").groupBy("v").agg(
            F.count("*").alias("n"))
        assert exact_quantile(df, "v", q) == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
def test_cumulative_counts(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    values = spark.range(1, 301).select(
        (F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("v"),
        F.lit(2).cast("long").alias("n"))
    got = {(r.g, r.v): (r.cum_n, r.next_value)
           for r in cumulative_counts(values, "g", "v", ["n"]).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 300
    for (g, v), (cum, following) in got.items():
        assert cum == 2 * sum(1 for i in range(1, 301) if str(i % 3) == g and i <= v)
        assert following == (v + 3 if v + 3 <= 300 else None)


def drift_case(spark, ref, cur):
    old, new = date(2020, 1, 1), date(2021, 1, 20)
    data = [(old, None if v is None else float(v)) for v in ref]
    data += [(new, None if v is None else float(v)) for v in cur]
    df = spark.createDataFrame(data, "date date, x double")
    return D.drift_statistics(df, ["x"], SETTINGS.cutoff, SETTINGS.as_of, 30)


def ecdf_gap(ref, cur):
    points = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), points, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), points, side="right") / len(cur)
    return points, np.abs(f - g)


@pytest.mark.parametrize("shift,levels", [(0.0, None), (0.8, None), (0.3, 4)])
def test_drift_statistics(spark, shift, levels):
    rng = np.random.default_rng(11)
    ref, cur = rng.normal(size=400), rng.normal(shift, 1, size=90)
    if levels:                             # heavy ties
        ref, cur = np.round(ref * levels / 4), np.round(cur * levels / 4)
    row = drift_case(spark, [*ref, None], [*cur, None, None]).first()
    points, gap = ecdf_gap(ref, cur)
    assert (row.reference_rows, row.current_rows) == (400, 90)
    assert row.ks_statistic == pytest.approx(gap.max())
    scale = gap.max() * np.sqrt(400 * 90 / 490)
    k = np.arange(1, 101)
    p = np.clip(2 * np.sum((-1.0) ** (k - 1) * np.exp(-2 * k**2 * scale**2)), 0, 1)
    assert row.ks_p_value == pytest.approx(p if scale >= 0.2 else 1.0, abs=1e-9)
    area = np.sum(gap[:-1] * np.diff(points)) / max(ref.std(), 0.001)
    assert row.distance == pytest.approx(area)


def test_drift_of_equal_and_apart_samples(spark):
    same = drift_case(spark, range(50), range(50))
    assert D.drift_report(same, "ks").first().drift_detected is False
    assert D.drift_report(same, "wasserstein").first().score == 0.0
    apart = drift_case(spark, range(50), range(100, 150))
    assert D.drift_report(apart, "ks").first().drift_detected is True
    assert D.drift_summary(D.drift_report(apart, "auto")).first() == (1, 1)


def test_drift_without_current_rows_has_no_score(spark):
    row = D.drift_report(drift_case(spark, range(50), []), "ks").first()
    assert row.score is None and row.drift_detected is False


def test_metrics_of_degenerate_predictions(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "target int, prediction int")
    assert tuple(M.classification_metrics(df).first()) == (3, 0.6667, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([(0, 1), (0, 0)], "target int, prediction int")
    assert tuple(M.classification_metrics(df).first()) == (2, 0.5, 0.0, 0.0, 0.0)


def test_majority_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (0,)], "target int")
    assert M.majority_class(df).first() == (0, 2)
    assert M.baseline_accuracy(df, df.limit(0)).first().baseline_accuracy == 0.0


def test_newest_rows(spark):
    df = spark.createDataFrame(
        [("A", date(2020, 1, d), None if d == 9 else float(d)) for d in range(1, 10)]
        + [("B", date(2020, 1, 1), 1.0)], "ticker string, date date, v double")
    assert rows(latest_per_key(df)) == [("A", date(2020, 1, 9), None), ("B", date(2020, 1, 1), 1.0)]
    assert last_rows_per_key(df, 3).count() == 4


def test_scoring_statuses(spark, trained):
    df, model, *_ = trained
    newest = df.where("ticker = 'A'").agg(F.max("date")).first()[0]
    gap = df.withColumn("vix", F.when((F.col("ticker") == "A") & (F.col("date") == F.lit(newest)), None)
                        .otherwise(F.col("vix")))
    wanted = entity_frame(spark, "ticker", ["A", "B", "Q"])
    got = {r.ticker: r for r in V.score_latest(gap, model, SETTINGS, wanted).collect()}
    assert (got["A"].status, got["A"].prediction) == ("incomplete_features", None)
    assert got["B"].status == "ok" and got["B"].prediction in ("up", "down")
    assert (got["B"].prediction == "up") == (got["B"].probability_up >= 0.5)
    assert got["B"].feature_freshness == "stale"
    assert (got["Q"].status, got["Q"].feature_freshness) == ("not_found", None)
    bare = replace(model, logistic=None)
    assert {r.status for r in V.score_latest(df, bare, SETTINGS).collect()} == {"model_unavailable"}


def test_recent_anomalies(spark, trained):
    df, model, *_ = trained
    got = {r.ticker: r for r in V.recent_anomalies(
        df, model, SETTINGS, entity_frame(spark, "ticker", ["A", "Q"])).collect()}
    listed = got["A"].anomalies
    assert len(listed) == 30 and [x.date for x in listed] == sorted(x.date for x in listed)
    assert got["A"].anomaly_rate == pytest.approx(sum(x.is_anomaly for x in listed) / 30, abs=1e-4)
    assert got["Q"].status == "not_found"
    bare = replace(model, forest=None)
    assert {r.status for r in V.recent_anomalies(df, bare, SETTINGS).collect()} == {"model_unavailable"}


def test_saved_model_and_missing_artifacts(spark, trained, tmp_path):
    df, model, *_ = trained
    store = Store(spark, str(tmp_path / "full"))
    R.save_model(store, model, SETTINGS)
    record = R.evaluate(df, model, SETTINGS)
    R.save_evaluation(store, record)
    again = R.load_model(store)
    assert again.scaler == model.scaler and again.logistic == model.logistic
    assert again.forest.threshold == model.forest.threshold
    trained_doc, doc = (store.read_metadata(s).first() for s in ("trained", "evaluated"))
    assert trained_doc.lr_accuracy is None and doc.lr_accuracy == record.first().lr_accuracy
    assert doc.n_train_rows == model.n_train and doc.majority_class == model.majority
    assert V.model_status(store).first().status == "ok"
    empty = Store(spark, str(tmp_path / "none"))
    status = V.model_status(empty).first()
    assert status.status == "degraded" and not any(status.artifacts_present)
    assert R.load_model(empty).scaler is None


def test_no_training_rows(spark):
    df, *_ = feature_rows(spark, 20)
    with pytest.raises(ValueError):
        R.train(df, replace(SETTINGS, cutoff=date(2019, 1, 1)))
