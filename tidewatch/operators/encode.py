"""Exact stratified split, and preparation of records for scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.joins import lookup_join
from tidewatch.functions.ranks import exact_quantiles
from tidewatch.functions.scalars import grouped_flag, log1p_clipped, number_or_zero
from tidewatch.operators.stages import IndicatorModel, RateModel


def split_hash(keys: Sequence[str], seed: int = v.SEED) -> Column:
    """53-bit hash of the row key: exact as a double, the same on every run and layout."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), 11).cast("double")


def stratified_split(
    df: DataFrame, stratum: str, keys: Sequence[str], test_share: float = v.TEST_SHARE,
    seed: int = v.SEED, hashed: Column | None = None, output: str = "split",
) -> DataFrame:
    """Mark each row 'train' or 'test'; each stratum sends round(share * n) rows to test.

    The threshold is the hash at that rank, found by the distributed order statistic, so
    nothing is sorted globally and the target never leaves its row.
    """
    order = hashed if hashed is not None else split_hash(keys, seed)
    rows = df.withColumn("_hash", order)
    thresholds = exact_quantiles(
        rows, "_hash", [test_share], [stratum], position=lambda p, n: F.floor(F.lit(p) * n + 0.5)
    ).select(stratum, F.col("quantiles")[0].alias("_threshold"))
    located = lookup_join(rows, thresholds, [stratum])
    # No row has the rank: the share takes the whole stratum.
    whole = F.col("_threshold").isNull() & F.col(stratum).isNotNull()
    side = F.when((F.col("_hash") < F.col("_threshold")) | whole, "test").otherwise("train")
    return located.withColumn(output, side).select(*df.columns, output)


def fill_absent(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add columns the record lacks; a NULL in a present column is left alone."""
    return df.withColumns({c: F.lit(x) for c, x in defaults.items() if c not in df.columns})


def coerce_numbers(df: DataFrame, columns: Sequence[str] = v.SCORING_NUMERIC) -> DataFrame:
    """Read each column as a number, unreadable or missing values become 0."""
    return df.withColumns({c: number_or_zero(F.col(c), df.schema[c].dataType) for c in columns if c in df.columns})


def align_columns(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected columns in order; absent ones are 0, others are dropped."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


def prepare_records(
    df: DataFrame,
    rates: RateModel | None = None,
    expected: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    numeric: Sequence[str] = v.SCORING_NUMERIC,
    text_defaults: Mapping[str, str] = v.DEFAULT_TEXT,
    logged: Sequence[str] = v.LOGGED,
    grouped: str = v.GROUPED,
    categories: Mapping[str, Sequence[str]] | None = None,
    service: str = "service",
    rate_column: str = "service_anomaly_rate",
) -> DataFrame:
    """From partial raw records to the model's feature columns, for a table or a stream."""
    full = fill_absent(df, {**{c: 0 for c in numeric}, **text_defaults})
    numbers = coerce_numbers(full, numeric)
    derived = numbers.withColumns({f"{c}_log": log1p_clipped(F.col(c)) for c in logged})
    if grouped in derived.columns:
        derived = derived.withColumn(f"{grouped}_grouped", grouped_flag(F.col(grouped)))
    rated = (
        rates.transform(derived) if rates is not None
        else derived.withColumn(rate_column, F.lit(v.MISSING_ENCODER_RATE))
    )
    table = categories or {"protocol_type": v.PROTOCOLS, "flag": v.FLAGS}
    encoded = IndicatorModel.fixed({c: list(x) for c, x in table.items()}).transform(rated).drop(service)
    return align_columns(encoded, expected, keep) if expected is not None else encoded


def decide(df: DataFrame, score: Column, version: str, threshold: float = v.DECISION_THRESHOLD) -> DataFrame:
    """Add the response columns anomaly, anomaly_score, model_version."""
    return df.withColumns({
        "anomaly": score >= threshold,
        "anomaly_score": F.round(score, 4),
        "model_version": F.lit(version),
    })


def linear_score(weights: Mapping[str, float], intercept: float) -> Column:
    """Logistic score of a linear model with known coefficients."""
    margin = sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(intercept))
    return 1.0 / (1.0 + F.exp(-margin))
