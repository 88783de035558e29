"""Data-quality profile: every check returns a small findings DataFrame.

Checks over many columns are one aggregate over one scan, turned into rows afterwards; the
result has one row per column, so nothing here grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch import vocabulary as v
from tidewatch.functions.joins import attach
from tidewatch.functions.ranks import exact_quantiles
from tidewatch.functions.scalars import any_of, digested, known, long_form, numeric_columns, parse_number, ratio, text, text_columns
from tidewatch.functions.storage import materialize

#: Rows looked at for a value near which sums of squares are taken.
HEAD = 1000
#: A variance under this part of the mean square is rounding.
ROUNDING = 1e-12


def per_column(df: DataFrame, measures: Mapping[str, Mapping[str, Column]], key: str = "column") -> DataFrame:
    """Run one aggregate and return it as rows: {column: {metric: aggregate}} -> (column, metric…)."""
    structs = [
        F.struct(F.lit(name).alias(key), *[agg.alias(metric) for metric, agg in metrics.items()])
        for name, metrics in measures.items()
    ]
    return df.agg(F.array(*structs).alias("_rows")).select(F.inline("_rows"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def share_pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


# Missing values ----------------------------------------------------------------------------


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns that hold missing values (NULL or NaN), with their counts."""
    names = columns or df.columns
    counts = per_column(df, {c: {"nulls": F.count_if(known(df, c).isNull())} for c in names})
    return counts.where("nulls > 0")


def total_nulls(df: DataFrame) -> DataFrame:
    cells = reduce(lambda a, b: a + b, [F.when(known(df, c).isNull(), 1).otherwise(0) for c in df.columns])
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).cast("long").alias("total_null_cells"))


def encoded_missing(df: DataFrame, tokens: Sequence[str] = v.MISSING_TOKENS) -> DataFrame:
    """Text columns holding placeholder tokens (exact, case-sensitive match)."""
    counts = per_column(df, {c: {"tokens": F.count_if(F.col(c).isin(*tokens))} for c in text_columns(df)})
    return counts.where("tokens > 0")


# Duplicates --------------------------------------------------------------------------------


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Exact copies beyond the first; nulls compare equal. Copies collapse before the shuffle."""
    groups = digested(df).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    total = F.coalesce(F.sum("_copies"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return groups.agg(
        total.alias("rows"),
        extra.alias("duplicate_rows"),
        share_pct(extra, total, 2).alias("duplicate_pct"),
    )


# Consistency, types, domains ---------------------------------------------------------------


def connection_rules() -> dict[str, tuple[set[str], Column]]:
    """The two record rules, each with the columns it needs."""
    return {
        v.RULE_ROOT_WITHOUT_EVIDENCE: (
            {"su_attempted", "root_shell", "num_root"},
            (F.col("su_attempted") == 1) & (F.col("root_shell") == 0) & (F.col("num_root") == 0),
        ),
        v.RULE_LAND_WITHOUT_BYTES: (
            {"land", "src_bytes", "dst_bytes"},
            (F.col("land") == 1) & (F.col("src_bytes") == 0) & (F.col("dst_bytes") == 0),
        ),
    }


def inconsistent_rows(df: DataFrame, rules: Mapping[str, tuple[set[str], Column]] | None = None) -> DataFrame:
    """Rows meeting each contradiction rule; rules whose columns are absent are skipped."""
    active = {
        name: {"rows": F.count_if(condition)}
        for name, (needs, condition) in (rules or connection_rules()).items()
        if needs <= set(df.columns)
    }
    return per_column(df, active, key="rule")


def type_family(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    return "text" if isinstance(data_type, T.StringType) else data_type.typeName()


def expected_families(df: DataFrame) -> dict[str, str]:
    """Symbolic columns are text (binary ones are not checked), all non-targets else are numeric."""
    skip = {*v.BINARY_SYMBOLIC, *v.TARGETS}
    return {c: "text" if c in v.SYMBOLIC else "numeric" for c in df.columns if c not in skip}


def type_profile(df: DataFrame, expected: Mapping[str, str] | None = None) -> DataFrame:
    """Expected and actual type family per column, and how many values do not read as numbers."""
    expected = expected or expected_families(df)
    actual = {f.name: type_family(f.dataType) for f in df.schema.fields}
    measures = {}
    for c, family in expected.items():
        if c not in actual:
            continue
        # A column known to be numeric holds numbers: nothing is printed and parsed again.
        stray = F.lit(0).cast("long") if actual[c] == "numeric" else F.count_if(F.col(c).isNotNull() & parse_number(F.col(c)).isNull())
        measures[c] = {
            "expected": F.lit(family),
            "actual": F.lit(actual[c]),
            "matches": F.lit(actual[c] == family),
            "not_numbers": stray if family == "numeric" else F.lit(0).cast("long"),
        }
    return per_column(df, measures)


def unexpected_categories(df: DataFrame, allowed: Mapping[str, Sequence] = v.ALLOWED) -> DataFrame:
    """Values outside the allowed set per column with their counts; NULL is outside too.

    All columns share one scan; only stray values reach the shuffle, collapsed per task.
    """
    present = [c for c in allowed if c in df.columns]
    cells = F.array(*[
        F.when(
            F.col(c).isNull() | ~F.col(c).isin(*allowed[c]),
            F.struct(F.lit(c).alias("column"), text(F.col(c)).alias("value")),
        )
        for c in present
    ])
    stray = df.select(F.explode(F.array_compact(cells)).alias("cell")).select("cell.*")
    return stray.groupBy("column", "value").agg(F.count("*").alias("rows"))


def impossible_values(
    df: DataFrame, non_negative: Sequence[str] = v.NON_NEGATIVE, rates: Sequence[str] = v.RATES
) -> DataFrame:
    """Negative counts and rates outside [0, 1]; columns without any are left out, and NaN is missing, not out of range."""
    measures = {}
    for c in non_negative:
        if c in df.columns:
            measures[f"{c}{v.NEGATIVE_SUFFIX}"] = {"rows": F.count_if(known(df, c) < 0)}
    for c in rates:
        if c in df.columns:
            measures[f"{c}{v.OUTSIDE_RATE_SUFFIX}"] = {"rows": F.count_if((known(df, c) < 0) | (known(df, c) > 1))}
    return per_column(df, measures, key="finding").where("rows > 0")


def cardinality(df: DataFrame, columns: list[str] | None = None, relative_error: float | None = None) -> DataFrame:
    """Distinct counts of text columns, nulls ignored; exact unless `relative_error` is given.

    Values are made distinct per column inside each task before the shuffle, in one pass
    over all columns. With `relative_error` only sketches are shuffled.
    """
    names = columns or text_columns(df)
    if relative_error is not None:
        return per_column(df, {c: {"distinct_values": F.approx_count_distinct(c, relative_error)} for c in names})
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.unhex(F.sha2(text(F.col(c)), 256)).alias("value")) for c in names
    ]))
    distinct = df.select(cells.alias("cell")).select("cell.*").distinct()
    return distinct.groupBy("column").agg(F.count("value").alias("distinct_values"))


# Spread ------------------------------------------------------------------------------------


def outliers_long(cells: DataFrame, factor: float = v.IQR_FACTOR) -> DataFrame:
    """Outliers of a long frame (feature, value) whose features are columns of known tables.

    Values strictly outside [Q1 - f·IQR, Q3 + f·IQR], count and percent of all rows; features
    with a zero range or without outliers are left out.
    """
    quartiles = exact_quantiles(cells, "value", [0.25, 0.75], ["feature"])
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    bounds = quartiles.where(q3 != q1).select(
        "feature", (q1 - factor * (q3 - q1)).alias("lower"), (q3 + factor * (q3 - q1)).alias("upper")
    )
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return (
        attach(cells, bounds, ["feature"], "inner", small=True).groupBy("feature")
        .agg(F.count_if(outside).alias("outliers"), F.count("*").alias("_rows"))
        .where("outliers > 0")
        .select("feature", "outliers", share_pct(F.col("outliers"), F.col("_rows"), 2).alias("pct"))
    )


def outliers_iqr(df: DataFrame, columns: list[str] | None = None, factor: float = v.IQR_FACTOR) -> DataFrame:
    """Extreme outliers of the numeric columns."""
    return outliers_long(long_form(df, columns or numeric_columns(df, exclude=["is_anomaly"])), factor)


def top_outliers(findings: DataFrame, limit: int = 5) -> DataFrame:
    return findings.orderBy(F.desc("pct"), "feature").limit(limit)


def skewness(df: DataFrame, columns: list[str] | None = None, limit: float | None = v.SKEW_LIMIT) -> DataFrame:
    """Bias-adjusted skewness; constant columns give 0. With `limit`, only |skew| above it."""
    names = columns or numeric_columns(df)
    measures = {}
    for c in names:
        x = known(df, c).cast("double")
        n = F.count(x).cast("double")
        adjusted = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2) * F.skewness(x)
        measures[c] = {"skewness": F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(adjusted)}
    rows = per_column(df, measures, key="feature")
    return rows.where(F.abs("skewness") > limit) if limit is not None else rows


def zscore_extremes(
    df: DataFrame, columns: list[str] | None = None, target: Column | None = None, limit: float = v.Z_LIMIT
) -> DataFrame:
    """Rows with any |z| above `limit` (population deviation), and how many of them are anomalies.

    Means and deviations come from one aggregate used as a scalar subquery by the second pass.
    """
    names = columns or numeric_columns(df, exclude=["is_anomaly"])
    moments = df.agg(F.struct(*[
        F.struct(F.avg(known(df, c)).alias("mean"), F.stddev_pop(known(df, c)).alias("std")).alias(c) for c in names
    ]).alias("_moments"))
    of = moments.scalar()
    far = any_of([
        F.coalesce(F.abs(ratio(known(df, c) - of[c]["mean"], of[c]["std"])) > limit, F.lit(False)) for c in names
    ])
    hit = target if target is not None else F.lit(None).cast("int")
    flags = df.select(far.alias("_far"), (hit == 1).alias("_hit"))
    extreme = F.count_if("_far")
    overlap = F.count_if(F.col("_far") & F.col("_hit"))
    return flags.agg(
        extreme.alias("extreme_rows"),
        share_pct(extreme, F.count("*"), 2).alias("extreme_pct"),
        overlap.alias("anomaly_overlap"),
        share_pct(overlap, F.greatest(extreme, F.lit(1)), 1).alias("overlap_pct"),
    )


# Correlation -------------------------------------------------------------------------------


def gram_matrix(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """M'M over rows (present, x, x * x) of the columns, x being the distance from a value of the column, 0 if missing.

    One job over the data, whatever the number of columns and wherever they have gaps; 3k x 3k numbers reach the
    driver. The distance keeps sums of squares small; any value near the bulk will do, so it
    is looked up in the first rows only and decides no result.
    """
    middle = df.limit(HEAD).agg(*[F.percentile_approx(known(df, c).cast("double"), 0.5).alias(f"_{k}") for k, c in enumerate(names)]).first()
    there = [F.when(known(df, c).isNotNull(), 1.0).otherwise(0.0) for c in names]
    away = [F.coalesce(known(df, c).cast("double") - F.lit(float(middle[f"_{k}"] or 0)), F.lit(0.0)) for k, c in enumerate(names)]
    cells = df.select(*[x.alias(f"_p{k}") for k, x in enumerate(there)], *[x.alias(f"_x{k}") for k, x in enumerate(away)])
    vectors = cells.select(array_to_vector(F.array(
        *[F.col(f"_p{k}") for k in range(len(names))], *[F.col(f"_x{k}") for k in range(len(names))],
        *[F.col(f"_x{k}") * F.col(f"_x{k}") for k in range(len(names))])).alias("_row"))
    rows = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_row"), numCols=3 * len(names))
    return rows.computeGramianMatrix().toArray()


def _correlations(df: DataFrame, names: Sequence[str], pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str, float | None]]:
    """Pearson r of each pair over the rows where both are present; None when either is constant there."""
    gram, k, at = gram_matrix(df, names), len(names), {c: i for i, c in enumerate(names)}
    out = []
    for a, b in pairs:
        i, j = at[a], at[b]
        n = gram[i, j]
        sx, sy, sxx, syy, sxy = gram[k + i, j], gram[k + j, i], gram[2 * k + i, j], gram[2 * k + j, i], gram[k + i, k + j]
        if n == 0:
            out.append((a, b, None))
            continue
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        constant = vx <= ROUNDING * sxx or vy <= ROUNDING * syy
        out.append((a, b, None if constant else float((sxy - sx * sy / n) / np.sqrt(vx * vy))))
    return out


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, r) for the upper triangle, without columns that hold one value only.

    Each pair counts its own complete rows; all come from one matrix of sums (`gram_matrix`).
    """
    names = columns or numeric_columns(df, exclude=["is_anomaly"])
    found = _correlations(df, names, [(a, b) for i, a in enumerate(names) for b in names[i:]]) if names else []
    flat = {a for a, b, r in found if a == b and r is None}
    rows = [(a, b, r) for a, b, r in found if a != b and not {a, b} & flat]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")


def correlated_pairs(df: DataFrame, columns: list[str] | None = None, limit: float = v.CORRELATION_LIMIT) -> DataFrame:
    """Pairs with |r| above `limit`, strongest first."""
    strength = F.abs("r")
    return (
        correlation_pairs(df, columns).where(strength > limit)
        .select("feature_a", "feature_b", F.round(strength, 3).alias("abs_r"))
        .orderBy(F.desc("abs_r"), "feature_a", "feature_b")
    )


def strongest_pairs(pairs: DataFrame, limit: int = 10) -> DataFrame:
    return pairs.orderBy(F.desc("abs_r"), "feature_a", "feature_b").limit(limit)


def target_correlation(df: DataFrame, features: Sequence[str] = v.KEY_FEATURES, target: str = "is_anomaly") -> DataFrame:
    """Correlation of each feature with the target, one pass over the data; constants give NULL."""
    present = [c for c in features if c in df.columns]
    found = _correlations(df, list(dict.fromkeys([*present, target])), [(c, target) for c in present]) if present else []
    rows = df.sparkSession.createDataFrame([(c, r) for c, _, r in found], "feature string, r double")
    return rows.orderBy(F.desc_nulls_last("r"), "feature")


# Classes -----------------------------------------------------------------------------------


def class_distribution(df: DataFrame, column: str = "attack_category") -> DataFrame:
    """Rows and percent of all rows per class; a missing class counts only in the denominator."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    return (
        counts.where(F.col(column).isNotNull())
        .select(F.col(column).alias("class"), "rows", share_pct(F.col("rows"), total, 3).alias("pct"))
        .orderBy(F.desc("rows"), "class")
    )


def class_imbalance(df: DataFrame, column: str = "attack_category") -> DataFrame:
    """Largest and smallest class and their ratio; equal counts are settled by class name."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    smallest = F.min(F.struct("rows", column))
    largest = F.min(F.struct((-F.col("rows")).alias("negated"), F.col(column)))
    return counts.agg(
        largest[column].alias("majority"),
        smallest[column].alias("minority"),
        ratio(F.max("rows"), F.min("rows")).alias("ratio"),
    )


# Schema findings ---------------------------------------------------------------------------


def schema_difference(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns missing from or not expected in the data (metadata only)."""
    missing = [(c, "missing") for c in expected if c not in df.columns]
    extra = [(c, "unexpected") for c in df.columns if c not in expected]
    return df.sparkSession.createDataFrame(missing + extra, "column string, difference string")


def leakage_inventory(df: DataFrame) -> DataFrame:
    """Target-derived columns and the two behaviour-window groups present in the schema."""
    names = df.columns
    rows = []
    if {"attack_category", "label"} <= set(names):
        rows += [(v.LEAKAGE_TARGETS, c) for c in ("attack_category", "is_anomaly", "label")]
    rows += [(v.LEAKAGE_TWO_SECONDS, c) for c in names if c in v.TWO_SECOND_COLUMNS]
    rows += [(v.LEAKAGE_HUNDRED, c) for c in names if c.startswith(v.HUNDRED_PREFIX)]
    return df.sparkSession.createDataFrame(rows, "finding string, column string")


def window_columns_kept(df: DataFrame) -> DataFrame:
    rows = [(c,) for c in v.TWO_SECOND_KEPT if c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column string")


def static_findings(df: DataFrame) -> DataFrame:
    """Checks without a computation: no dates, no mixed units, no time gaps to measure."""
    rows = list(v.STATIC_FINDINGS)
    return df.sparkSession.createDataFrame(rows, "check string, applicable boolean, finding string")


def quality_report(df: DataFrame) -> DataFrame:
    """All profile checks as one long table (check, column, metric, value, detail).

    The table is stored first: many checks read it, and a view of joins would be joined again for each of them.
    """
    df = materialize(df)

    def rows(check: str, frame: DataFrame, column: Column, metric: str, value: Column, detail: Column | None = None):
        return frame.select(
            F.lit(check).alias("check"), text(column).alias("column"), F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            text(detail if detail is not None else F.lit(None)).alias("detail"),
        )

    duplicates = duplicate_profile(df)
    anomalies = zscore_extremes(df, target=F.col("is_anomaly") if "is_anomaly" in df.columns else None)
    types = type_profile(df).where("not matches")
    parts = [
        rows("missing_values", null_profile(df), F.col("column"), "nulls", F.col("nulls")),
        rows("duplicates", duplicates, F.lit(None), "duplicate_rows", F.col("duplicate_rows")),
        rows("duplicates", duplicates, F.lit(None), "duplicate_pct", F.col("duplicate_pct")),
        rows("incorrect_types", types, F.col("column"), "not_numbers", F.col("not_numbers"), F.col("actual")),
        rows("impossible_values", impossible_values(df), F.col("finding"), "rows", F.col("rows")),
        rows("outliers", outliers_iqr(df), F.col("feature"), "outliers", F.col("outliers")),
        rows("skewness", skewness(df), F.col("feature"), "skewness", F.col("skewness")),
        rows("excessive_correlation", correlated_pairs(df), F.col("feature_a"), "abs_r", F.col("abs_r"), F.col("feature_b")),
        rows("statistical_anomalies", anomalies, F.lit(None), "extreme_rows", F.col("extreme_rows")),
        rows("leakage", leakage_inventory(df), F.col("column"), "present", F.lit(1), F.col("finding")),
        rows("static", static_findings(df), F.col("check"), "applicable", F.col("applicable").cast("int"), F.col("finding")),
    ]
    if text_columns(df):
        parts.append(rows("encoded_missing", encoded_missing(df), F.col("column"), "tokens", F.col("tokens")))
        parts.append(rows("cardinality", cardinality(df), F.col("column"), "distinct_values", F.col("distinct_values")))
    if any(c in df.columns for c in v.ALLOWED):
        stray = unexpected_categories(df)
        parts.append(rows("inconsistent_categories", stray, F.col("column"), "rows", F.col("rows"), F.col("value")))
    if {"su_attempted", "root_shell", "num_root"} <= set(df.columns) or {"land", "src_bytes", "dst_bytes"} <= set(df.columns):
        parts.append(rows("inconsistent_records", inconsistent_rows(df), F.col("rule"), "rows", F.col("rows")))
    if "attack_category" in df.columns:
        parts.append(rows("imbalance", class_distribution(df), F.col("class"), "rows", F.col("rows")))
    return union_all(parts)
