"""The end-to-end flows: feature preparation, training and evaluation, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.operators import evaluate, models
from tidewatch.operators.clean import dedup_global, verified_distinct
from tidewatch.operators.encode import prepare_records, stratified_split
from tidewatch.operators.targets import feature_columns, pipeline_targets
from tidewatch.sources.artifacts import Scorer


def prepare_features(raw: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """Targets, global dedup, then the column pipeline; returns the clean table and the fitted pipeline.

    Whether a column is constant does not depend on copies, so fitting skips the dedup shuffle.
    """
    marked = pipeline_targets(raw)
    pipeline = models.feature_pipeline().fit(marked)
    return pipeline.transform(dedup_global(marked)), pipeline


@dataclass
class TrainTest:
    train: DataFrame
    test: DataFrame
    features: list[str]
    encoder: PipelineModel


def prepare_train_test(
    clean: DataFrame, keys: Sequence[str], service: str = "service",
    symbolic: Sequence[str] = ("protocol_type", "flag"), target: str = "is_anomaly",
    drop: Sequence[str] = (), distinct: bool = True,
) -> TrainTest:
    """Safety dedup, exact stratified split, encoders fitted on the training rows only.

    Targets and row keys travel with both sides, so nothing has to be joined back later.
    """
    rows = verified_distinct(clean)[0] if distinct else clean
    marked = stratified_split(rows, target, keys)
    train, test = (marked.where(F.col("split") == side).drop("split") for side in ("train", "test"))
    encoder = models.encoding_pipeline(service, list(symbolic), target).fit(train)
    encoded = encoder.transform(train)
    skip = {*keys, *drop, target}
    features = [c for c in feature_columns(encoded, v.TARGETS) if c not in skip]
    return TrainTest(encoded, encoder.transform(test), features, encoder)


def score_records(
    records: DataFrame, encoder: PipelineModel, model: PipelineModel, features: Sequence[str], version: str, keep: Sequence[str],
    **roles,
) -> DataFrame:
    """Partial raw records -> keep…, anomaly, anomaly_score, model_version.

    The stages fitted in training do the encoding (rate first, indicators last), so training
    and scoring cannot drift apart. Works on a table and, with a broadcast rate table, on a stream.
    """
    rates, indicators = encoder.stages[0], encoder.stages[-1]
    prepared = prepare_records(
        records, rates, features, keep, categories=indicators.getOrDefault(indicators.categories),
        service=rates.getOrDefault(rates.key), **roles,
    )
    return models.respond(model, prepared, list(keep), version)


def score_with(scorer: Scorer, records: DataFrame, keep: Sequence[str], **roles) -> DataFrame:
    """`score_records` with what `artifacts.load_scorer` brought back; for a table or a stream."""
    return score_records(records, scorer.encoder, scorer.model, scorer.features, scorer.version, keep, **roles)


def train_and_evaluate(data: TrainTest, category: str, keep: Sequence[str], target: str = "is_anomaly") -> dict[str, tuple[PipelineModel, DataFrame]]:
    """Fit the three classifiers; each comes with its (metric, value) rows, recall per category included."""
    train = data.train.persist()
    try:
        fitted = {
            "baseline_logistic_regression": models.fit_logistic(train, data.features, target),
            "random_forest": models.fit_forest(train, data.features, target),
            "gradient_boosting": models.fit_boosting(train, data.features, target),
        }
    finally:
        train.unpersist()
    results = {}
    for name, model in fitted.items():
        scored = models.score(model, data.test, [*keep, category, target])
        metrics = evaluate.run_metrics(scored, target, "prediction", "score")
        recalls = evaluate.category_recall(scored, category, target, "prediction").select(
            F.concat(F.lit("recall_"), F.col("category")).alias("metric"), F.col("recall").alias("value")
        )
        results[name] = (model, metrics.unionByName(recalls))
    return results
