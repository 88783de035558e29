"""Exploratory tables: per-class medians, boxes, shares, histograms and service risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.joins import lookup_join
from tidewatch.functions.ranks import exact_quantiles
from tidewatch.functions.scalars import log1p_clipped, long_form, not_missing, ratio, text


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("class"))
        .agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "class")
    )


def median_by_class(df: DataFrame, column: str, values: Sequence[str], keep_input: bool = False) -> DataFrame:
    """(class, feature, median), exact. `keep_input` stores class and values once, for derived inputs."""
    cells = long_form(df.withColumn("class", F.col(column)), list(values), keep=["class"])
    medians = exact_quantiles(cells, "value", [0.5], ["class", "feature"], keep_input=keep_input)
    return medians.select("class", "feature", F.col("quantiles")[0].alias("median"))


def mean_by_class(df: DataFrame, column: str, value: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("class"))
        .agg(F.avg(value).alias("mean")).orderBy(F.desc_nulls_last("mean"), "class")
    )


def boxplot_by_class(df: DataFrame, column: str, values: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Box and whiskers of log1p(value) per class, fliers left out.

    Whiskers end at the outermost values within `reach` box heights, never inside the box.
    """
    logged = df.select(F.col(column).alias("class"), *[log1p_clipped(F.col(c)).alias(c) for c in values])
    cells = long_form(logged, list(values), keep=["class"])
    keys = ["class", "feature"]
    boxes = exact_quantiles(cells, "value", [0.25, 0.5, 0.75], keys).select(
        *keys, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    near = lookup_join(cells.where(F.col("class").isNotNull()), boxes, keys, "inner")
    height = F.col("q3") - F.col("q1")
    value = F.col("value")
    ends = near.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(value >= F.col("q1") - reach * height, value)).alias("_low"),
        F.max(F.when(value <= F.col("q3") + reach * height, value)).alias("_high"),
    )
    return ends.select(
        *keys, "q1", "median", "q3",
        F.least(F.col("_low"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.col("_high"), F.col("q3")).alias("whisker_high"),
    )


def crosstab_pct(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    """Share of each value within each class in percent; absent combinations give 0.

    The result has classes times values rows, whatever their number.
    """
    both = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).select(
        F.col(rows).alias("class"), text(F.col(columns)).alias("value")
    )
    counts = both.groupBy("class", "value").agg(F.count("*").alias("n"))
    totals = both.groupBy("class").agg(F.count("*").alias("total"))
    known = F.array(*[F.lit(x) for x in values]) if values is not None else counts.select(F.collect_set("value")).scalar()
    grid = totals.select("class", "total", F.explode(known).alias("value"))
    return grid.join(counts, ["class", "value"], "left").select(
        "class", "value", F.round(ratio(F.coalesce("n", F.lit(0)), F.col("total")) * 100, 1).alias("pct")
    )


def service_risk(
    df: DataFrame, service: str = "service", target: str = "is_anomaly",
    support: int = v.SERVICE_SUPPORT, top: int = v.SERVICE_TOP,
) -> DataFrame:
    """Services with the highest anomaly share among those with enough rows."""
    return (
        df.where(F.col(service).isNotNull()).groupBy(service)
        .agg(F.avg(target).alias("anomaly_rate"), F.count(target).alias("connections"))
        .where(F.col("connections") >= support)
        .orderBy(F.desc("anomaly_rate"), service).limit(top)
    )


def service_risk_by_key(
    facts: DataFrame, fact_key: str, services: DataFrame, service_key: str, service: str,
    target: str = "is_anomaly", support: int = v.SERVICE_SUPPORT, top: int = v.SERVICE_TOP,
) -> DataFrame:
    """`service_risk` when the service sits in a table reached by a key.

    Facts are summed per key first, so the join carries one row per key and a hot key is
    already collapsed; Spark picks the join from the sizes it sees.
    """
    sums = facts.groupBy(fact_key).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n"))
    named = services.where(F.col(service).isNotNull()).select(F.col(service_key).alias(fact_key), service)
    return (
        sums.join(named, fact_key).groupBy(service)
        .agg(ratio(F.sum("_sum"), F.sum("_n")).alias("anomaly_rate"), F.sum("_n").alias("connections"))
        .where(F.col("connections") >= support)
        .orderBy(F.desc("anomaly_rate"), service).limit(top)
    )


def histogram_by_class(df: DataFrame, column: str, value: str, bins: int = v.HISTOGRAM_BINS) -> DataFrame:
    """Density histogram per class over that class's own range; the last bin is closed.

    A class with a single value gets the range value ± 0.5. Empty bins are listed with 0.
    """
    rows = df.select(F.col(column).alias("class"), F.col(value).cast("double").alias("_x")).where(
        F.col("class").isNotNull() & not_missing(F.col("_x"))
    )
    low, high = F.min("_x"), F.max("_x")
    pad = F.when(low == high, 0.5).otherwise(0.0)
    ranges = rows.groupBy("class").agg(
        F.count("*").alias("_n"), (low - pad).alias("_low"), (high + pad).alias("_high")
    )
    located = lookup_join(rows, ranges, ["class"], "inner")
    step = (F.col("_high") - F.col("_low")) / bins
    first = F.least(
        F.floor((F.col("_x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins), F.lit(bins - 1)
    )
    guess = located.withColumn("_guess", first.cast("int")).withColumn("_step", step)
    edge = F.col("_guess") * F.col("_step") + F.col("_low")
    next_edge = (F.col("_guess") + 1) * F.col("_step") + F.col("_low")
    settled = (
        F.col("_guess")
        - F.when(F.col("_x") < edge, 1).otherwise(0)
        + F.when((F.col("_x") >= next_edge) & (F.col("_guess") != bins - 1), 1).otherwise(0)
    )
    counts = (
        guess.withColumn("bin", settled)
        .groupBy("class", "bin").agg(
            F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("_n", "_low", "_step")]
        )
    )
    cells = F.map_from_entries(F.collect_list(F.struct("bin", "n")))  # at most `bins` entries
    every = counts.groupBy("class").agg(
        cells.alias("_cells"), *[F.min(c).alias(c) for c in ("_n", "_low", "_step")]
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.col("_cells")[F.col("bin")], F.lit(0)).cast("long")
    return every.select(
        "class", "bin",
        (F.col("bin") * F.col("_step") + F.col("_low")).alias("left_edge"),
        n.alias("rows"),
        (n / (F.col("_n") * F.col("_step"))).alias("density"),
    )


def split_summary(df: DataFrame, split: str = "split", target: str = "is_anomaly") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("rows"), F.avg(target).alias("anomaly_share"))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
