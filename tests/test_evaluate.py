import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidewatch.functions import ranks
from tidewatch.operators import evaluate


@pytest.fixture(scope="module")
def scored(spark):
    random = np.random.default_rng(2)
    label = (random.random(3000) < 0.3).astype(int)
    score = np.where(random.random(3000) < 0.35, 0.5, np.round(random.normal(0.4 + 0.2 * label, 0.2), 2))
    rows = [(int(y), float(s), int(s >= 0.5), "odd" if i % 2 else "even") for i, (y, s) in enumerate(zip(label, score))]
    return spark.createDataFrame(rows, "label int, score double, prediction int, g string"), label, score


def auc_brute(label, score):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))


def test_auc(scored):
    df, label, score = scored
    auc = evaluate.roc_auc(df, "score", "label").first().auc
    assert auc == pytest.approx(auc_brute(label, score), abs=1e-12)
    assert evaluate.roc_auc(df.withColumn("score", -F.col("score")), "score", "label").first().auc == pytest.approx(1 - auc)
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert exact.evaluate(df) == pytest.approx(auc)


def test_auc_over_cells(scored, monkeypatch):
    df, label, score = scored
    monkeypatch.setattr(ranks, "TASK_ROWS", 10)
    assert evaluate.roc_auc(df, "score", "label").first().auc == pytest.approx(auc_brute(label, score), abs=1e-12)
    found = {r.g: r.auc for r in evaluate.roc_auc(df, "score", "label", ["g"]).collect()}
    assert found["odd"] == pytest.approx(auc_brute(label[1::2], score[1::2]))


def test_auc_by_group_and_single_class(scored):
    df, label, score = scored
    found = {r.g: r.auc for r in evaluate.roc_auc(df, "score", "label", ["g"]).collect()}
    assert found["even"] == pytest.approx(auc_brute(label[::2], score[::2]))
    assert evaluate.roc_auc(df.where("label = 1"), "score", "label").first().auc is None


def test_cells_are_always_four(spark):
    df = spark.createDataFrame([(0, 0)] * 3, "label int, prediction int")
    assert [tuple(r) for r in evaluate.confusion(df, "label", "prediction").collect()] == [(0, 0, 3), (0, 1, 0), (1, 0, 0), (1, 1, 0)]
    health = evaluate.model_health(df, "label", "prediction").first()
    assert tuple(health) == (0.0, 0.0, 0.0, 0.0)
    assert evaluate.model_health(df, None, "prediction").columns == ["anomaly_rate"]


def test_report_against_definitions(scored):
    df, label, score = scored
    said = (score >= 0.5).astype(int)
    rows = {r["class"]: r for r in evaluate.class_report(df, "label", "prediction").collect()}
    precision = (label[said == 1] == 1).mean()
    recall = (said[label == 1] == 1).mean()
    assert rows["anomalía"].precision == pytest.approx(precision) and rows["anomalía"].recall == pytest.approx(recall)
    assert rows["accuracy"].recall == pytest.approx((said == label).mean())
    assert rows["normal"].support + rows["anomalía"].support == rows["macro avg"].support == 3000
    metrics = {r.metric: r.value for r in evaluate.run_metrics(df, "label", "prediction", "score").collect()}
    assert metrics["recall_binary"] == pytest.approx(recall)
    assert metrics["f1_macro"] == pytest.approx(rows["macro avg"].f1)


def test_best_run(spark):
    df = spark.createDataFrame([("lr", 0.625), ("rf", 0.8125), ("gbt", 0.9375), ("none", None)], "run_name string, u2r double")
    assert evaluate.best_run(df, "u2r").first().run_name == "gbt"
