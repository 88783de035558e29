"""Fitted pipelines and models on shared storage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tidewatch.operators import stages  # noqa: F401  (custom stages must be importable when loading)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class Scorer:
    """All that scoring needs: the encoders and the model fitted in training, and the order of the features."""

    encoder: PipelineModel
    model: PipelineModel
    features: tuple[str, ...]
    version: str


def save_scorer(spark: SparkSession, scorer: Scorer, path: str) -> None:
    save_model(scorer.encoder, f"{path}/encoder")
    save_model(scorer.model, f"{path}/model")
    order = [(i, c, scorer.version) for i, c in enumerate(scorer.features)]
    spark.createDataFrame(order, "place int, feature string, version string").coalesce(1).write.mode("overwrite").json(f"{path}/features")


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    order: Sequence = spark.read.schema("place int, feature string, version string").json(f"{path}/features").orderBy("place").collect()
    return Scorer(load_model(f"{path}/encoder"), load_model(f"{path}/model"), tuple(r["feature"] for r in order), order[0]["version"])
