"""Target columns: label clean-up, taxonomy, binary target, leakage removal."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.scalars import clean_label, map_values


def add_category(
    df: DataFrame,
    label: str = "label",
    mapping: Mapping[str, str] | None = None,
    default: str = v.DOTTED_DEFAULT,
    clean: bool = False,
    output: str = "attack_category",
) -> DataFrame:
    """Map labels to categories unless the column is already there; unmapped labels get `default`."""
    if output in df.columns:
        return df
    if label not in df.columns:
        raise ValueError(f"neither {output!r} nor {label!r} is in the data")
    table = v.DOTTED_TAXONOMY if mapping is None else mapping
    key = clean_label(F.col(label)) if clean else F.col(label)
    return df.withColumn(output, map_values(key, table, default))


def add_anomaly(df: DataFrame, source: str = "attack_category", clean: bool = False,
                normal: str = v.NORMAL, output: str = "is_anomaly") -> DataFrame:
    """1 when `source` differs from the normal value; an unmapped category counts as an anomaly."""
    if output in df.columns:
        return df
    value = clean_label(F.col(source)) if clean else F.col(source)
    return df.withColumn(output, (~value.eqNullSafe(F.lit(normal))).cast("int"))


def pipeline_targets(df: DataFrame) -> DataFrame:
    """Targets of the feature pipeline: dotted labels, default 'desconocido'."""
    return add_anomaly(add_category(df))


def profile_targets(df: DataFrame) -> DataFrame:
    """Targets of the quality profile: cleaned labels, default 'unknown', both or neither added."""
    if "attack_category" in df.columns or "label" not in df.columns:
        return df
    with_category = add_category(df, mapping=v.PLAIN_TAXONOMY, default=v.PLAIN_DEFAULT, clean=True)
    return add_anomaly(with_category.drop("is_anomaly"), source="label", clean=True)


def feature_columns(df: DataFrame, leakage: list[str] = v.TARGETS) -> list[str]:
    return [c for c in df.columns if c not in leakage]


def drop_leakage(df: DataFrame, leakage: list[str] = v.TARGETS) -> DataFrame:
    return df.drop(*leakage)
