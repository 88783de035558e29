"""Queries: fitting and scoring the three classifiers, choosing one, scoring with what was saved.

Solvers and tree growth have no SQL form; their properties do, and have queries with SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.storage import fresh_folder
from tidewatch.operators import evaluate, models
from tidewatch.plans.flows import TrainTest, prepare_train_test, score_with
from tidewatch.plans.registry import query, shown
from tidewatch.sources import artifacts, views
from tidewatch.streaming import jobs

KEYS = ["doc_id"]


def documents_split(spark, folder) -> TrainTest:
    """Toxicity of labelled documents from source, language, length and quality."""
    documents = views.labelled_documents(spark, folder).withColumn(
        "attack_category", F.when(F.col("is_anomaly") == 1, "toxic").otherwise("normal")
    )
    return prepare_train_test(documents, KEYS, symbolic=["protocol_type"], distinct=False)


def _scored(fit, spark, folder) -> DataFrame:
    data = documents_split(spark, folder)
    model = _fitted(fit, data)
    return shown(models.score(model, data.test, [*KEYS, "is_anomaly"]))


def _fitted(fit, data: TrainTest):
    """Fitting reads the training rows several times; keep them for that long."""
    train = data.train.persist()
    try:
        return fit(train, data.features, "is_anomaly")
    finally:
        train.unpersist()


@query("lr_fit_score")
def lr_fit_score(spark, folder):
    return _scored(models.fit_logistic, spark, folder)


@query("rf_fit_score")
def rf_fit_score(spark, folder):
    return _scored(models.fit_forest, spark, folder)


@query("gbt_fit_score")
def gbt_fit_score(spark, folder):
    return _scored(models.fit_boosting, spark, folder)


@query("model_pick")
def model_pick(spark, folder):
    """The three models compared on recall in the rarest category."""
    data = documents_split(spark, folder)
    fitted = {"baseline_logistic_regression": models.fit_logistic, "random_forest": models.fit_forest, "gradient_boosting": models.fit_boosting}
    runs = []
    for name, fit in fitted.items():
        scored = models.score(_fitted(fit, data), data.test, [*KEYS, "is_anomaly", "attack_category"])
        recalls = evaluate.category_recall(scored, "attack_category", "is_anomaly", "prediction")
        runs.append(recalls.agg(F.min_by("recall", F.struct("total", "category")).alias("recall_minority")).select(
            F.lit(name).alias("run_name"), "recall_minority"))
    return shown(evaluate.best_run(reduce(DataFrame.unionByName, runs), "recall_minority"))


#: Roles of the documents' columns when they are scored as raw records.
ROLES = {"numeric": ["n_chars", "quality"], "logged": [], "text_defaults": {}, "grouped": "absent"}
RECORD = "doc_id long, service string, protocol_type string, n_chars long, quality long"
_MARKED = "(SELECT doc_id, toxic FROM documents JOIN labels USING (doc_id))"


@query("train_save_score", f"SELECT doc_id, true AS same_after_loading, true AS same_on_a_stream FROM {_MARKED}")
def train_save_score(spark, folder):
    """Train, save, load, then score all documents as raw records: as a table, and as a stream in four micro-batches.

    Each score is compared with that of the model in memory on the encoded rows.
    """
    data = documents_split(spark, folder)
    model = _fitted(models.fit_logistic, data)
    path, parts, output = (fresh_folder(spark, name) for name in ("scorer", "records", "scored"))
    artifacts.save_scorer(spark, artifacts.Scorer(data.encoder, model, tuple(data.features), "lr-1"), path)
    scorer = artifacts.load_scorer(spark, path)

    labelled = views.labelled_documents(spark, folder)
    records = labelled.select("doc_id", "service", "protocol_type", F.col("n_chars").cast("long").alias("n_chars"), F.col("quality").cast("long").alias("quality"))
    direct = models.score(model, data.encoder.transform(labelled), KEYS).select("doc_id", F.round("score", 4).alias("_direct"))
    table = score_with(scorer, records, KEYS, **ROLES).select("doc_id", F.col("anomaly_score").alias("_table"))
    records.repartition(4).write.parquet(parts)
    stream = jobs.file_stream(spark, parts, records.schema, files=1)
    jobs.to_files(score_with(scorer, stream, KEYS, **ROLES), output).awaitTermination()
    streamed = spark.read.parquet(f"{output}/data").select("doc_id", F.col("anomaly_score").alias("_stream"))
    near = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1e-4, F.lit(False))
    return direct.join(table, "doc_id", "left").join(streamed, "doc_id", "left").select(
        "doc_id", near("_direct", "_table").alias("same_after_loading"), near("_direct", "_stream").alias("same_on_a_stream"))


_SIDES = f"""(SELECT sum(n - floor(0.2 * n + 0.5))::BIGINT AS train, sum(floor(0.2 * n + 0.5))::BIGINT AS test, min(n) AS least
              FROM (SELECT toxic, count(*)::DOUBLE AS n FROM {_MARKED} GROUP BY toxic))"""


@query("fit_properties", f"""
    SELECT 'logistic' AS model, 'gradient is zero' AS property, true AS holds, train AS rows FROM {_SIDES}
    UNION ALL SELECT m, p, true, CASE p WHEN 'better than chance in training' THEN train ELSE test END
    FROM {_SIDES}, (VALUES ('logistic'), ('forest'), ('boosting')) a(m), (VALUES ('scores are shares'), ('better than chance in training')) b(p)
    UNION ALL SELECT 'choice', 'largest recall of the rarest class', true, 3""")
def fit_properties(spark, folder):
    """What must hold of any solver and any tree growth, for the three models on one split."""
    data = documents_split(spark, folder)
    fits = {"logistic": models.fit_logistic, "forest": lambda *a: models.fit_forest(*a, trees=20, max_depth=12), "boosting": lambda *a: models.fit_boosting(*a, rounds=10)}
    fitted = {name: _fitted(fit, data) for name, fit in fits.items()}
    slope = models.penalised_gradient(fitted["logistic"], data.train, "is_anomaly").agg((F.max(F.abs("gradient")) < 1e-5).alias("holds"))
    rows = [(slope.select(F.lit("logistic").alias("model"), F.lit("gradient is zero").alias("property"), "holds", F.lit(data.train.count()).alias("rows")))]
    runs = []
    for name, model in fitted.items():
        test = models.score(model, data.test, ["is_anomaly", "attack_category"])
        shares = test.agg(F.bool_and(F.col("score").between(0, 1) & ((F.col("score") > 0.5) == (F.col("prediction") == 1) | (F.col("score") == 0.5))).alias("holds"), F.count("*").alias("rows"))
        rows.append(shares.select(F.lit(name).alias("model"), F.lit("scores are shares").alias("property"), "holds", "rows"))
        train = models.score(model, data.train, ["is_anomaly"])
        chance = evaluate.roc_auc(train, "score", "is_anomaly").select((F.col("auc") > 0.5).alias("holds"))
        rows.append(chance.select(F.lit(name).alias("model"), F.lit("better than chance in training").alias("property"), "holds", F.lit(train.count()).alias("rows")))
        recalls = evaluate.category_recall(test, "attack_category", "is_anomaly", "prediction")
        runs.append(recalls.agg(F.min_by("recall", F.struct("total", "category")).alias("recall_minority")).select(F.lit(name).alias("run_name"), "recall_minority"))
    compared = reduce(DataFrame.unionByName, runs)
    best, most = evaluate.best_run(compared, "recall_minority").first(), compared.agg(F.max("recall_minority").alias("m"), F.count("*").alias("rows"))
    rows.append(most.select(F.lit("choice").alias("model"), F.lit("largest recall of the rarest class").alias("property"), (F.col("m") == F.lit(best["recall_minority"])).alias("holds"), "rows"))
    return reduce(DataFrame.unionByName, rows)
