"""Population stability, two-sample Kolmogorov-Smirnov and the retraining rule."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.joins import attach, fits_broadcast
from tidewatch.functions.prefix import running_sums
from tidewatch.functions.ranks import exact_quantiles
from tidewatch.functions.scalars import bin_of, long_form, not_missing, ratio
from tidewatch.functions.storage import materialize

SERIES_TERMS = 100
#: Largest product of sample sizes whose lattice paths are counted.
EXACT_PATHS = 10_000


def common_features(reference: DataFrame, production: DataFrame, features: list[str]) -> list[str]:
    return [c for c in features if c in reference.columns and c in production.columns]


def reference_edges(reference: DataFrame, buckets: int = v.PSI_BUCKETS) -> DataFrame:
    """(feature, edges) from a long reference (feature, value): padded linear percentiles.

    Kept once computed: reference and production are both counted against these very edges.
    """
    probs = [i / buckets for i in range(buckets + 1)]
    quantiles = exact_quantiles(reference, "value", probs, ["feature"])
    q = F.col("quantiles")
    edges = [q[0] - v.PSI_EDGE_PAD, *[q[i] for i in range(1, buckets)], q[buckets] + v.PSI_EDGE_PAD]
    return materialize(quantiles.select("feature", F.array(*edges).alias("edges")))


def bucket_counts(
    cells: DataFrame, edges: DataFrame, keys: list[str], buckets: int = v.PSI_BUCKETS, small: bool | None = None
) -> DataFrame:
    """(keys…, n, _b0, _b1, …): clean values, and those in each bucket; outside values in none.

    The last bucket is closed. Empty buckets appear because every bucket is its own counter.
    """
    value, last = F.col("value"), F.col("edges")[buckets]
    place = F.when(value == last, buckets - 1).otherwise(bin_of("value", "edges", buckets + 1) - 1)
    small = fits_broadcast(edges) if small is None else small
    binned = attach(cells, edges, ["feature"], "left", small).withColumn(
        "_bin", F.when(not_missing(value) & (value <= last), place)
    )
    return binned.groupBy(*keys).agg(
        F.count_if(not_missing(value)).alias("n"),
        *[F.count_if(F.col("_bin") == i).alias(f"_b{i}") for i in range(buckets)],
    )


def shares_of(counts: DataFrame, keys: list[str], buckets: int = v.PSI_BUCKETS) -> DataFrame:
    """(keys…, n, shares) of bucket counts."""
    shares = F.array(*[ratio(F.col(f"_b{i}"), F.col("n")) for i in range(buckets)])
    return counts.select(*keys, "n", shares.alias("shares"))


def bucket_shares(
    cells: DataFrame, edges: DataFrame, keys: list[str], buckets: int = v.PSI_BUCKETS, small: bool | None = None
) -> DataFrame:
    """(keys…, n, shares): part of all clean values in each bucket."""
    return shares_of(bucket_counts(cells, edges, keys, buckets, small), keys, buckets)


def stability(expected: Column, actual: Column) -> Column:
    filled = lambda s: F.when(s == 0, v.PSI_EMPTY_SHARE).otherwise(s)
    terms = F.zip_with(expected, actual, lambda r, p: (filled(p) - filled(r)) * F.ln(filled(p) / filled(r)))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def psi_long(
    reference: DataFrame, production: DataFrame, keys: list[str] = (), buckets: int = v.PSI_BUCKETS, few: bool = False
) -> DataFrame:
    """PSI per feature (and per key) of long frames (feature, value); 0 when a side is empty.

    `few` says that the schema bounds the number of features; else it is checked.
    """
    edges = reference_edges(reference, buckets)
    small = few or fits_broadcast(edges)
    expected = bucket_shares(reference, edges, ["feature"], buckets, small).select(
        "feature", F.col("n").alias("n_reference"), F.col("shares").alias("_expected")
    )
    actual = bucket_shares(production, edges, ["feature", *keys], buckets, small)
    joined = attach(actual, expected, ["feature"], "left", small)
    filled = (F.col("n") > 0) & (F.coalesce(F.col("n_reference"), F.lit(0)) > 0)
    psi = F.when(filled, stability(F.col("_expected"), F.col("shares"))).otherwise(F.lit(0.0))
    return joined.select("feature", *keys, psi.alias("psi"))


def psi_by_feature(reference: DataFrame, production: DataFrame, features: list[str], buckets: int = v.PSI_BUCKETS) -> DataFrame:
    """One PSI per common feature, also for an empty production frame."""
    names = common_features(reference, production, features)
    found = psi_long(long_form(reference, names), long_form(production, names), buckets=buckets, few=True)
    listed = reference.sparkSession.createDataFrame([(c,) for c in names], "feature string")
    return listed.join(found, "feature", "left").select("feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))


def psi_by_batch(reference: DataFrame, production: DataFrame, features: list[str], batch: str, buckets: int = v.PSI_BUCKETS) -> DataFrame:
    """PSI and short status per production batch and feature against one reference."""
    names = common_features(reference, production, features)
    found = psi_long(long_form(reference, names), long_form(production, names, keep=[batch]), [batch], buckets, few=True)
    return found.withColumn("status", drift_status(F.col("psi")))


def drift_status(psi: Column, alert: str = v.STATUS_ALERT) -> Column:
    return (
        F.when(psi < v.PSI_WARNING, v.STATUS_OK)
        .when(psi < v.PSI_ALERT, v.STATUS_WARNING)
        .otherwise(alert)
    )


def kolmogorov_tail(strength: Column) -> Column:
    """Limiting P(K > strength); the series that converges fast is used on each side."""
    terms = F.transform(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), lambda k: k.cast("double"))
    square = strength * strength
    upper = F.aggregate(
        terms, F.lit(0.0),
        lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * square),
    )
    odd = lambda k: (2 * k - 1) * (2 * k - 1)
    lower = F.aggregate(
        terms, F.lit(0.0), lambda a, k: a + F.exp(ratio(-odd(k) * math.pi ** 2, 8.0 * square))
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) * ratio(lower, strength)
    tail = F.when(strength <= 0, 1.0).when(strength < 1.0, small).otherwise(upper)
    return F.when(strength.isNotNull(), F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def lattice_tail(gap: Column, n: Column, m: Column) -> Column:
    """P(D >= gap) for two samples of n and m values of one continuous distribution, by counting lattice paths.

    An order of all n + m values is a path from (0, 0) to (n, m), all equally likely. D < gap holds for the
    paths that stay where |i / n - j / m| < gap, in whole numbers |i * m - j * n| < gap * n * m. A cell keeps
    the part of the paths to it that stayed inside: of the paths to (i, j), i in i + j come from
    below and the others from the left. Rows go over the larger sample, so a row is short.
    """
    width, height = F.least(n, m).cast("int"), F.greatest(n, m).cast("int")
    limit = F.round(gap * n * m).cast("long")
    inside = lambda i, j: F.abs(i * width.cast("long") - j * height.cast("long")) < limit
    part = lambda k, i, j: k.cast("double") / F.greatest(i + j, F.lit(1))

    def row(below: Column, i: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            came = part(i, i, j) * F.coalesce(F.get(below, j), F.lit(0.0)) + part(j, i, j) * F.coalesce(F.get(done, j - 1), F.lit(0.0))
            first = F.when((i == 0) & (j == 0), F.lit(1.0)).otherwise(came)
            return F.concat(done, F.array(F.when(inside(i, j), first).otherwise(F.lit(0.0))))

        return F.aggregate(F.sequence(F.lit(0), width), F.array().cast("array<double>"), cell)

    last = F.aggregate(F.sequence(F.lit(0), height), F.array().cast("array<double>"), row)
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.get(last, width))


def greatest_divisor(a: Column, b: Column) -> Column:
    """Greatest common divisor of two positive whole numbers, by Euclid's steps (92 suffice for 64 bits)."""
    pair = lambda x, y: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    step = lambda s, _: F.when(s["y"] == 0, s).otherwise(pair(s["y"], s["x"] % F.when(s["y"] != 0, s["y"])))
    return F.aggregate(F.sequence(F.lit(1), F.lit(92)), pair(a, b), step)["x"]


def ks_p_value(gap: Column, n: Column, m: Column) -> Column:
    """P(D >= gap). Exact while n * m <= EXACT_PATHS; beyond, the limiting tail corrected for finite size.

    The correction (Kim and Jennrich 1973) is for P(D > x); gaps are multiples of 1 / lcm(n, m), so x is the one below.
    """
    root, small, large = F.sqrt(ratio(n.cast("double") * m, n + m)), F.least(n, m), F.greatest(n, m)
    below = F.greatest(gap - greatest_divisor(n, m) / (n.cast("double") * m), F.lit(0.0))
    wide = F.sqrt(large.cast("double"))
    more = F.when(large > 2 * small, 1 / (2 * wide)).when(large % small == 0, 2 / (3 * wide)).otherwise(2 / (5 * wide))
    corrected = F.when(gap <= 0, F.lit(1.0)).otherwise(kolmogorov_tail(root * below + more))
    # `gap` is known only if both sides have values, so no branch divides by zero.
    return F.when(gap.isNotNull(), F.when(n * m <= EXACT_PATHS, lattice_tail(gap, n, m)).otherwise(corrected))


def ks_long(reference: DataFrame, production: DataFrame, few: bool = False, cells: int | None = None) -> DataFrame:
    """Two-sample KS per feature of long frames: statistic, p-value, sizes.

    Both samples collapse to distinct values, which are counted along the order of (feature, value) in cells of
    equal size; a feature's own counts are the difference to where it starts, so a feature that
    holds most rows is no single task's work.
    """
    both = reference.select("feature", "value", F.lit(1).alias("ref"), F.lit(0).alias("prod")).unionByName(
        production.select("feature", "value", F.lit(0).alias("ref"), F.lit(1).alias("prod"))
    ).where(F.col("feature").isNotNull() & not_missing(F.col("value")))
    counts = both.groupBy("feature", F.col("value").cast("double").alias("value")).agg(F.sum("ref").alias("ref"), F.sum("prod").alias("prod"))
    own = counts.select("feature", "value", "ref", "prod", F.col("ref").alias("upto_ref"), F.col("prod").alias("upto_prod"))
    summed = running_sums(own, ["feature", "value"], ["upto_ref", "upto_prod"], cells)
    features = materialize(summed.groupBy("feature").agg(
        F.sum("ref").alias("n_reference"), F.sum("prod").alias("n_production"),
        F.min(F.col("upto_ref") - F.col("ref")).alias("_from_ref"), F.min(F.col("upto_prod") - F.col("prod")).alias("_from_prod"),
    ))
    placed = attach(summed, features, ["feature"], "inner", few or fits_broadcast(features))
    gap = ratio(F.col("upto_ref") - F.col("_from_ref"), F.col("n_reference")) - ratio(F.col("upto_prod") - F.col("_from_prod"), F.col("n_production"))
    found = placed.groupBy("feature", "n_reference", "n_production").agg(F.max(F.abs(gap)).alias("ks"))
    return found.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_reference"), F.col("n_production")))


def ks_by_feature(reference: DataFrame, production: DataFrame, features: list[str]) -> DataFrame:
    names = common_features(reference, production, features)
    return ks_long(long_form(reference, names), long_form(production, names), few=True)


def drift_table(reference: DataFrame, production: DataFrame, features: list[str]) -> DataFrame:
    """Per common feature: PSI, KS p-value (both rounded to 4) and the long status."""
    psi = psi_by_feature(reference, production, features)
    ks = ks_by_feature(reference, production, features).select("feature", "p_value")
    return psi.join(F.broadcast(ks), "feature", "left").select(
        "feature", F.round("psi", 4).alias("psi"), F.round("p_value", 4).alias("ks_p_value"),
        drift_status(F.col("psi"), v.STATUS_ALERT_LONG).alias("status"),
    )


def retraining_decision(
    df: DataFrame, psi: str = "psi", performance: str = "performance",
    psi_limit: float = v.RETRAIN_PSI, performance_limit: float = v.RETRAIN_PERFORMANCE,
) -> DataFrame:
    """Add should_retrain and reason: retrain only on drift together with degradation (both strict)."""
    drifted = F.col(psi) > psi_limit
    degraded = F.col(performance) < performance_limit
    say = lambda pattern: F.format_string(pattern, F.col(psi).cast("double"), F.col(performance).cast("double"))
    reason = (
        F.when(drifted & degraded, say("retrain: drift (psi %.4f) and degraded performance (%.4f)"))
        .when(drifted, say("watch: drift (psi %.4f) but performance holds (%.4f)"))
        .when(degraded, say("investigate: no drift (psi %.4f) but degraded performance (%.4f)"))
        .otherwise(F.lit("keep: no drift and no degradation"))
    )
    return df.withColumns({
        "should_retrain": F.coalesce(drifted & degraded, F.lit(False)),
        "reason": reason,
    })
