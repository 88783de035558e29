import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import evaluate, models
from tidewatch.plans.flows import prepare_features, prepare_train_test, score_records, train_and_evaluate
from tidewatch.sources import artifacts


@pytest.fixture(scope="module")
def data(spark):
    random = np.random.default_rng(9)
    rows = []
    for i in range(400):
        y = int(random.random() < 0.3)
        rows.append((i, "ab"[y if random.random() < 0.8 else 1 - y], random.choice(["tcp", "udp"]), float(random.normal(2 * y, 1)), y, "dos" if y else "normal"))
    df = spark.createDataFrame(rows, "id int, service string, protocol_type string, x double, is_anomaly int, attack_category string")
    return prepare_train_test(df, ["id"], symbolic=["protocol_type"])


def test_sides_share_columns(data):
    assert data.train.columns == data.test.columns
    assert data.features == ["x", "service_anomaly_rate", "protocol_type_tcp", "protocol_type_udp"]
    assert data.test.count() == 80


def test_logistic_reaches_the_penalised_optimum(data):
    """Coefficients against a Newton solution of the same objective."""
    model = models.fit_logistic(data.train, data.features, "is_anomaly")
    frame = data.train.toPandas()
    x = frame[data.features].astype(float).to_numpy()
    x = (x - x.mean(0)) / np.where(x.std(0) == 0, 1, x.std(0))
    y = frame.is_anomaly.to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    design = np.hstack([x, np.ones((len(y), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) + penalty @ beta
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(beta[:-1], abs=1e-4)
    assert model.stages[-1].intercept == pytest.approx(beta[-1], abs=1e-4)


def test_trees_and_saved_model(data, tmp_path):
    forest = models.fit_forest(data.train, data.features, "is_anomaly", trees=10)
    boosted = models.fit_boosting(data.train, data.features, "is_anomaly", rounds=5)
    for model in (forest, boosted):
        scored = models.score(model, data.test, ["id", "is_anomaly"])
        assert evaluate.roc_auc(scored, "score", "is_anomaly").first().auc > 0.85
        assert scored.where("score < 0 or score > 1").count() == 0
    artifacts.save_model(boosted, str(tmp_path / "boosted"))
    again = artifacts.load_model(str(tmp_path / "boosted"))
    rows = lambda m: sorted(map(str, models.respond(m, data.test, ["id"], "boosted-1").collect()))
    assert rows(again) == rows(boosted) == rows(again)


def test_records_score_like_the_training_path(spark, data):
    model = models.fit_logistic(data.train, data.features, "is_anomaly")
    rows = [(1, "a", "tcp", "0.5"), (2, "never", "icmp", "2.5"), (3, None, None, "bad")]
    records = spark.createDataFrame(rows, "id int, service string, protocol_type string, x string")
    roles = {"numeric": ["x"], "logged": [], "text_defaults": {}, "grouped": "absent"}
    found = score_records(records, data.encoder, model, data.features, "lr-1", ["id"], **roles).collect()
    assert [r.id for r in found] == [1, 2, 3] and all(0 <= r.anomaly_score <= 1 and r.model_version == "lr-1" for r in found)
    typed = data.encoder.transform(records.withColumn("x", F.col("x").try_cast("double")).fillna({"x": 0.0}))
    direct = models.score(model, typed, ["id"]).collect()
    assert [r.anomaly_score for r in found] == pytest.approx([r.score for r in direct], abs=1e-4)


def test_one_class_is_refused(data):
    with pytest.raises(ValueError):
        models.with_balanced_weight(data.train.where("is_anomaly = 0"), "is_anomaly")


def test_train_and_evaluate(data, monkeypatch):
    monkeypatch.setattr(models, "fit_forest", lambda t, f, y: models._fit_trees(
        models.RandomForestClassifier(featuresCol="_features", labelCol=y, numTrees=5, seed=1), t, f))
    monkeypatch.setattr(models, "fit_boosting", lambda t, f, y: models._fit_trees(
        models.GBTClassifier(featuresCol="_features", labelCol=y, maxIter=3, seed=1), t, f))
    results = train_and_evaluate(data, "attack_category", ["id"])
    assert set(results) == set(models.ALGORITHMS)
    for _, metrics in results.values():
        found = {r.metric: r.value for r in metrics.collect()}
        assert {"auc", "recall_dos", "recall_normal", "f1_macro"} <= set(found) and found["auc"] > 0.8


def test_feature_flow(spark):
    df = spark.createDataFrame(
        [("smurf.", 10, 5, 0, 0), ("smurf.", 10, 5, 0, 0), ("normal.", 3, -1, 2, 0)],
        "label string, src_bytes int, dst_bytes int, su_attempted int, num_outbound_cmds int",
    )
    clean, fitted = prepare_features(df)
    assert clean.count() == 2 and "num_outbound_cmds" not in clean.columns
    assert {"src_bytes_log", "su_attempted_grouped", "attack_category", "is_anomaly"} <= set(clean.columns)
    assert fitted.transform(df.limit(1)).count() == 1
