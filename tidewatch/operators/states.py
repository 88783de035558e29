"""Column profiles as states that are stored by part (a day, a file's load) and merged when read.

A state holds what adds up: counts, extremes, centred moments, and two sketches of fixed size, one for
quantiles and ranks (KLL) and one for distinct values (HLL). A new part adds rows to the stored states and
reads nothing old; any set of parts is merged to the profile of their rows. Counts, extremes and moments are
exact (moments up to rounding); a rank from the merged quantile sketch is off by about `RANK_ERROR` of the rows at most
in 99 of 100 cases, the number of distinct values by a few hundredths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.scalars import long_form, not_missing, ratio

#: Size of a quantile sketch; its ranks are off by 1.33 % at most, with 99 % confidence.
SKETCH_SIZE = 200
RANK_ERROR = 0.0133


def column_states(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """(part, feature, n, missing, low, high, mean, m2, m3, quantiles, distinct): one row for each part and column.

    One grouped pass; a task sends one state for each part and column it saw. Missing values (NULL, NaN) are only counted.
    """
    cells = long_form(df, list(columns), keep=[part])
    x, known = F.col("value"), not_missing(F.col("value"))
    seen = F.when(known, x)
    mean, n = F.avg(seen), F.count_if(known)
    third = F.skewness(seen) * F.pow(F.var_pop(seen), F.lit(1.5)) * n
    return cells.groupBy(F.col(part).alias("part"), "feature").agg(
        n.alias("n"), F.count_if(~F.coalesce(known, F.lit(False))).alias("missing"), F.min(seen).alias("low"), F.max(seen).alias("high"),
        mean.alias("mean"), (F.var_pop(seen) * n).alias("m2"), F.coalesce(third, F.lit(0.0)).alias("m3"),
        F.kll_sketch_agg_double(seen, F.lit(SKETCH_SIZE)).alias("quantiles"), F.hll_sketch_agg(seen.cast("string")).alias("distinct"),
    )


def add_part(states: DataFrame, folder: str) -> None:
    """Store the states of new parts; a part that is there already is replaced, others are not touched."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder)


def read_states(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def merged(states: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """One state for each key: the state of all rows of its parts.

    Moments about each part's mean are moved to the common mean: with d the distance between the two,
    m2 gains n d^2 and m3 gains 3 d m2 + n d^3.
    """
    full = states.where("n > 0").groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    moved = states.join(full, list(keys), "left")
    n, d = F.col("n"), F.coalesce(F.col("mean") - F.col("_mean"), F.lit(0.0))
    return moved.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("_mean").alias("mean"),
        F.sum(F.coalesce("m2", F.lit(0.0)) + n * d * d).alias("m2"),
        F.sum(F.coalesce("m3", F.lit(0.0)) + 3 * d * F.coalesce("m2", F.lit(0.0)) + n * d * d * d).alias("m3"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"),
    )


def profile(state: DataFrame) -> DataFrame:
    """The figures of merged states: n, missing, low, high, mean, std (population), skewness (bias-adjusted), distinct."""
    n = F.col("n").cast("double")
    variance = ratio(F.col("m2"), n)
    skew = ratio(ratio(F.col("m3"), n), F.pow(variance, F.lit(1.5))) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    flat = F.col("low") == F.col("high")
    keys = [c for c in state.columns if c not in ("n", "missing", "low", "high", "mean", "m2", "m3", "quantiles", "distinct")]
    return state.select(
        *keys, "n", "missing", "low", "high", "mean", F.sqrt(variance).alias("std"),
        F.when(flat, F.lit(0.0)).otherwise(skew).alias("skewness"), F.hll_sketch_estimate("distinct").alias("distinct_values"),
    )


def quantile(at: float) -> Column:
    """The value of merged states at a rank between 0 and 1, from the sketch."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(at)))


def outlier_bounds(state: DataFrame, factor: float = 3.0) -> DataFrame:
    """(keys…, lower, upper): where extreme outliers begin, from the sketches' quartiles."""
    q1, q3 = quantile(0.25), quantile(0.75)
    keys = [c for c in state.columns if c not in ("n", "missing", "low", "high", "mean", "m2", "m3", "quantiles", "distinct")]
    return state.select(*keys, (q1 - factor * (q3 - q1)).alias("lower"), (q3 + factor * (q3 - q1)).alias("upper"))


def rank_gaps(state: DataFrame, cells: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("feature",)) -> DataFrame:
    """(keys…, prob, quantile, gap): how far the sketches' quantiles are from their place among the values of `cells` (keys…, value).

    A value that occurs often covers a range of ranks; the gap is the distance of the wanted one to that range.
    """
    asked = state.select(*keys, F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), quantile(p).alias("quantile")) for p in probs])).alias("a")).select(*keys, "a.*")
    known = cells.where(not_missing(F.col("value")))
    placed = known.join(F.broadcast(asked), list(keys)).groupBy(*keys, "prob", "quantile").agg(
        (F.count_if(F.col("value") < F.col("quantile")) / F.count("*")).alias("_under"), (F.count_if(F.col("value") <= F.col("quantile")) / F.count("*")).alias("_upto"))
    gap = F.greatest(F.col("_under") - F.col("prob"), F.col("prob") - F.col("_upto"), F.lit(0.0))
    return placed.select(*keys, "prob", "quantile", gap.alias("gap"))
