"""The feature pipeline and the three classifiers, as MLlib pipelines."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.storage import shared_folder
from tidewatch.operators.encode import decide
from tidewatch.operators.stages import (
    ColumnDropper, ConstantDropper, IndicatorEncoder, LogColumns, PopulationScaler, RateEncoder, ValueGrouper,
)

ALGORITHMS = {
    "baseline_logistic_regression": "LogisticRegression",
    "random_forest": "RandomForestClassifier",
    "gradient_boosting": "GBTClassifier",
}


def feature_pipeline(
    correlated: list[str] = v.CORRELATED, logged: list[str] = v.LOGGED,
    constant: list[str] = v.CONSTANT, grouped: str = v.GROUPED,
) -> Pipeline:
    """Column-wise cleaning in order. Deduplication drops rows, so it stays outside and a
    fitted pipeline can also transform records to be scored."""
    return Pipeline(stages=[
        ColumnDropper(columns=correlated), LogColumns(columns=logged),
        ConstantDropper(columns=constant), ValueGrouper(column=grouped),
    ])


def encoding_pipeline(service: str = "service", symbolic: list[str] = ("protocol_type", "flag"), target: str = "is_anomaly") -> Pipeline:
    """Service rate, then removal of the service column, then indicator columns."""
    return Pipeline(stages=[
        RateEncoder(key=service, target=target, output=f"{service}_anomaly_rate"),
        ColumnDropper(columns=[service]),
        IndicatorEncoder(columns=list(symbolic)),
    ])


#: Values (rows times features) in a partition while fitting.
TASK_VALUES = 4_000_000


def class_counts(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)).first()
    if not row[0] or not row[1]:
        raise ValueError("training rows must hold both classes")
    return row[0], row[1]


def _balanced(df: DataFrame, target: str, zeros: int, ones: int, output: str = "_weight") -> DataFrame:
    n = zeros + ones
    return df.withColumn(output, F.when(F.col(target) == 1, n / (2.0 * ones)).otherwise(n / (2.0 * zeros)))


def _positive(df: DataFrame, target: str, zeros: int, ones: int, output: str = "_weight") -> DataFrame:
    return df.withColumn(output, F.when(F.col(target) == 1, zeros / ones).otherwise(1.0))


def with_balanced_weight(df: DataFrame, target: str, output: str = "_weight") -> DataFrame:
    """n / (2 · rows of the class)."""
    return _balanced(df, target, *class_counts(df, target), output)


def with_positive_weight(df: DataFrame, target: str, output: str = "_weight") -> DataFrame:
    """Positives weigh (negatives / positives), negatives 1."""
    return _positive(df, target, *class_counts(df, target), output)


def penalised_gradient(model: PipelineModel, train: DataFrame, target: str) -> DataFrame:
    """(term, gradient) of the objective that `fit_logistic` minimises, at its solution: all near 0 if it is one."""
    zeros, ones = class_counts(train, target)
    fitted, scaled = model.stages[-1], model.transform(_balanced(train, target, zeros, ones))
    p, x = vector_to_array("probability")[1], vector_to_array("_features")
    error = F.col("_weight") * (p - F.col(target))
    total, n = F.sum("_weight"), len(fitted.coefficients)
    rows = scaled.select("_weight", error.alias("_e"), x.alias("_x"))
    sums = rows.agg((F.sum("_e") / total).alias("intercept"), *[(F.sum(F.col("_e") * F.col("_x")[k]) / total).alias(f"x{k}") for k in range(n)])
    penalty = {f"x{k}": float(c) / (zeros + ones) for k, c in enumerate(fitted.coefficients)}
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("term"), (F.col(c) + F.lit(penalty.get(c, 0.0))).alias("gradient")) for c in sums.columns])))


def _assembled(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="_features")


def fit_logistic(train: DataFrame, features: list[str], target: str, max_iter: int = v.LOGISTIC_ITERATIONS) -> PipelineModel:
    """Balanced L2 logistic regression on standardised columns.

    A penalty of strength 1 on the summed loss equals regParam = 1 / Σ weights; balanced
    weights add up to the number of rows.
    """
    zeros, ones = class_counts(train, target)
    weighted = _balanced(train, target, zeros, ones)
    classifier = LogisticRegression(
        featuresCol="_features", labelCol=target, weightCol="_weight", maxIter=max_iter, tol=1e-8,
        regParam=1.0 / (zeros + ones), elasticNetParam=0.0, standardization=False,
    )
    return Pipeline(stages=[
        PopulationScaler(columns=features), _assembled([f"{c}_scaled" for c in features]), classifier,
    ]).fit(_sized(weighted, zeros + ones, features))


def _sized(df: DataFrame, rows: int, features: list[str]) -> DataFrame:
    """No more partitions than hold TASK_VALUES values each: growing trees is hundreds of jobs over the same rows."""
    return df.coalesce(max(1, -(-rows * len(features) // TASK_VALUES)))


def _fit_trees(classifier: Estimator, weighted: DataFrame, features: list[str]) -> PipelineModel:
    shared_folder(weighted.sparkSession)  # boosting cuts its lineage there
    return Pipeline(stages=[_assembled(features), classifier]).fit(weighted)


def fit_forest(train: DataFrame, features: list[str], target: str, trees: int = v.TREES, max_depth: int = 30) -> PipelineModel:
    """Balanced random forest; the published one has no depth limit, and 30 is the deepest that MLlib grows.

    Each row's place in the trees is kept and checkpointed, so a deep level does not walk down from the roots again.
    """
    zeros, ones = class_counts(train, target)
    classifier = RandomForestClassifier(
        featuresCol="_features", labelCol=target, weightCol="_weight", numTrees=trees, cacheNodeIds=True, checkpointInterval=10,
        featureSubsetStrategy="sqrt", maxDepth=max_depth, seed=v.SEED, maxMemoryInMB=512,
    )
    return _fit_trees(classifier, _sized(_balanced(train, target, zeros, ones), zeros + ones, features), features)


def fit_boosting(train: DataFrame, features: list[str], target: str, rounds: int = v.BOOSTING_ROUNDS, max_depth: int = 6, step: float = 0.3) -> PipelineModel:
    """Boosted trees with the positive class weighted by the class ratio."""
    zeros, ones = class_counts(train, target)
    classifier = GBTClassifier(
        featuresCol="_features", labelCol=target, weightCol="_weight", maxIter=rounds, cacheNodeIds=True, checkpointInterval=10,
        maxDepth=max_depth, stepSize=step, seed=v.SEED, maxMemoryInMB=512,
    )
    return _fit_trees(classifier, _sized(_positive(train, target, zeros, ones), zeros + ones, features), features)


def score(model: PipelineModel, df: DataFrame, keep: list[str], output: str = "score") -> DataFrame:
    """keep…, predicted class and P(class 1)."""
    return model.transform(df).select(
        *keep, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias(output),
    )


def respond(model: PipelineModel, df: DataFrame, keep: list[str], version: str) -> DataFrame:
    scored = score(model, df, keep)
    return decide(scored, F.col("score"), version).select(*keep, "anomaly", "anomaly_score", "model_version")
