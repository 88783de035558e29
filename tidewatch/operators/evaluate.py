"""Exact evaluation of binary predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.ranks import before, cell_counts
from tidewatch.functions.scalars import ratio, ratio_or_zero


def _cells(label: str, prediction: str) -> dict[str, Column]:
    real, said = F.col(label) == 1, F.col(prediction) == 1
    return {
        "tn": F.count_if(~real & ~said), "fp": F.count_if(~real & said),
        "fn": F.count_if(real & ~said), "tp": F.count_if(real & said),
    }


def counts_row(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tn, fp, fn, tp as one row."""
    return df.agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(real, predicted, rows), always four cells."""
    cell = lambda real, said, name: F.struct(
        F.lit(real).alias("real"), F.lit(said).alias("predicted"), F.col(name).alias("rows"))
    return counts_row(df, label, prediction).select(F.inline(F.array(
        cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))))


def _scores() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    p0, r0 = ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, tn + fp)
    f1 = ratio_or_zero(2 * tp, 2 * tp + fp + fn)
    f0 = ratio_or_zero(2 * tn, 2 * tn + fp + fn)
    n0, n1 = tn + fp, fn + tp
    mean = lambda a, b: (a + b) / 2
    weighted = lambda a, b: ratio_or_zero(a * n0 + b * n1, n0 + n1)
    return {
        "p0": p0, "r0": r0, "f0": f0, "n0": n0, "p1": p1, "r1": r1, "f1": f1, "n1": n1,
        "accuracy": ratio_or_zero(tn + tp, n0 + n1),
        "pm": mean(p0, p1), "rm": mean(r0, r1), "fm": mean(f0, f1),
        "pw": weighted(p0, p1), "rw": weighted(r0, r1), "fw": weighted(f0, f1), "n": n0 + n1,
    }


def class_report(df: DataFrame, label: str, prediction: str, names: tuple[str, str] = ("normal", "anomalía")) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and weighted averages."""
    s = _scores()

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("long").alias("support"),
        )

    return counts_row(df, label, prediction).select(F.inline(F.array(
        line(names[0], s["p0"], s["r0"], s["f0"], s["n0"]),
        line(names[1], s["p1"], s["r1"], s["f1"], s["n1"]),
        line("accuracy", s["accuracy"], s["accuracy"], s["accuracy"], s["n"]),
        line("macro avg", s["pm"], s["rm"], s["fm"], s["n"]),
        line("weighted avg", s["pw"], s["rw"], s["fw"], s["n"]),
    )))


def category_recall(df: DataFrame, category: str, label: str, prediction: str) -> DataFrame:
    """Per true category: rows, right, wrong and share right (for 'normal' this is specificity)."""
    right = F.col(prediction) == F.col(label)
    return (
        df.where(F.col(category).isNotNull()).groupBy(F.col(category).alias("category"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(right).alias("detected"),
            F.count_if(~right).alias("missed"),
            F.avg(right.cast("int")).alias("recall"),
        )
    )


def roc_auc(df: DataFrame, score: str, label: str, groups: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve (ties count half); NULL when a class is absent.

    Rows collapse to distinct scores, distinct scores are ordered inside value cells, and
    only cell totals are ordered across a group.
    """
    measures = {
        "_pos": (F.col(label) == 1).cast("long"),
        "_neg": (F.col(label) == 0).cast("long"),
    }
    counts, keys = cell_counts(df, score, measures, groups)
    below = before("_neg", [*keys, "_cell"], "_x")
    pieces = (
        counts.withColumn("_below", below)
        .groupBy(*keys, "_cell").agg(
            F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"),
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_area"),
        )
        .withColumn("_below", before("_neg", keys, "_cell"))
    )
    area = F.sum(F.col("_area") + F.col("_pos").cast("double") * F.col("_below"))
    whole = F.sum("_pos").cast("double") * F.sum("_neg")
    return pieces.groupBy(*keys).agg(ratio(area, whole).alias("auc")).select(*groups, "auc")


def model_health(df: DataFrame, label: str | None, prediction: str, score: str | None = None) -> DataFrame:
    """Anomaly rate and, when the truth is known, precision, recall, F1 and AUC; rounded to 4."""
    rate = F.round(F.avg(F.col(prediction).cast("double")), 4).alias("anomaly_rate")
    if label is None:
        return df.agg(rate)
    s = _scores()
    cells = [c.alias(n) for n, c in _cells(label, prediction).items()]
    result = df.agg(rate, *cells).select(
        "anomaly_rate", F.round(s["p1"], 4).alias("precision"),
        F.round(s["r1"], 4).alias("recall"), F.round(s["f1"], 4).alias("f1_score"),
    )
    if score is None:
        return result
    return result.withColumn("auc_roc", F.round(roc_auc(df, score, label).scalar(), 4))


def run_metrics(df: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """(metric, value) rows for the run log. Binary and macro recall / F1 under their own names."""
    s = _scores()
    named = {
        "accuracy": s["accuracy"], "precision_macro": s["pm"], "recall_binary": s["r1"], "recall_macro": s["rm"],
        "f1_binary": s["f1"], "f1_macro": s["fm"], "f1_weighted": s["fw"],
        "auc": roc_auc(df, score, label).scalar(),
    }
    rows = [F.struct(F.lit(n).alias("metric"), x.alias("value")) for n, x in named.items()]
    return counts_row(df, label, prediction).select(F.inline(F.array(*rows)))


def best_run(metrics: DataFrame, recall: str) -> DataFrame:
    """The run with the highest recall in the rarest class; equal recalls go by name."""
    return metrics.orderBy(F.desc_nulls_last(recall), "run_name").limit(1)
