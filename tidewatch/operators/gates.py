"""Gates in front of the pipeline: a table of rules, and the hard stop."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.scalars import digested, known, ratio


#: Column that a guard adds for no longer than its own filter.
FAILURE = "_failure"


class GateFailure(Exception):
    """Raised by the first gate that does not pass."""


def gate_table(
    df: DataFrame,
    min_rows: int = v.MIN_ROWS,
    expected_columns: int = v.EXPECTED_COLUMNS,
    required: Sequence[str] = ("label",),
    max_duplicate_rate: float = v.MAX_DUPLICATE_RATE,
) -> DataFrame:
    """(position, gate, observed, threshold, passed), from one grouped pass over the data; texts travel as digests."""
    groups = digested(df).groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    judged = _judged(rows, extra, df.columns, min_rows, expected_columns, required, max_duplicate_rate)
    return groups.agg(F.array(*judged).alias("_gates")).select(F.inline("_gates"))


def _judged(
    rows: Column, extra: Column, columns: Sequence[str], min_rows: int, expected_columns: int, required: Sequence[str], max_duplicate_rate: float
) -> list[Column]:
    """The five gates over the number of rows and of copies beyond the first."""
    rate, width, present = ratio(extra, rows), len(columns), sum(c in columns for c in required)

    def gate(position: int, name: str, observed: Column, threshold: float, passed: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"), F.lit(name).alias("gate"),
            observed.cast("double").alias("observed"), F.lit(float(threshold)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    return [
        gate(1, "not_empty", rows, 0, rows > 0),
        gate(2, "minimum_rows", rows, min_rows, rows >= min_rows),
        gate(3, "column_count", F.lit(width), expected_columns, F.lit(width == expected_columns)),
        gate(4, "required_columns", F.lit(present), len(required), F.lit(present == len(required))),
        gate(5, "duplicate_rate", rate, max_duplicate_rate, rate < max_duplicate_rate),
    ]


def write_distinct(
    spark: SparkSession, build: Callable[[SparkSession], DataFrame], path: str, split: str | None = None, target: str | None = None,
    min_rows: int = v.MIN_ROWS, expected_columns: int = v.EXPECTED_COLUMNS, required: Sequence[str] = ("label",), max_duplicate_rate: float = v.MAX_DUPLICATE_RATE,
) -> tuple[DataFrame, DataFrame]:
    """Write the distinct rows of `build(session)` as Parquet and gather, while writing, (gates, facts).

    The session is a new one beside `spark`: a session that has observed a plan keeps an object that can't be serialised,
    and fitted models of that session could not be sent to tasks any more.

    The rows are counted on their way in and on their way out, so the duplicate rate needs no pass of its own. `facts`
    (fact, key, value): missing cells after cleaning, and for `split` and `target` the rows and the share of 1 in train and test.
    """
    df, came, left = build(spark.newSession()), Observation(), Observation()
    sides = ["train", "test"] if split else []
    held = [F.count_if(F.col(split) == side).alias(f"rows_{side}") for side in sides]
    held += [F.count_if((F.col(split) == side) & (F.col(target) == 1)).alias(f"ones_{side}") for side in sides if target]
    gaps = reduce(lambda a, b: a + b, [F.when(known(df, c).isNull(), 1).otherwise(0) for c in df.columns], F.lit(0))
    distinct = df.observe(came, F.count(F.lit(1)).alias("rows")).dropDuplicates()
    distinct.observe(left, F.count(F.lit(1)).alias("rows"), F.sum(gaps).alias("gaps"), *held).write.mode("overwrite").parquet(path)
    before, after = came.get, left.get
    rows, extra = F.lit(before["rows"]), F.lit(before["rows"] - after["rows"])
    judged = _judged(rows, extra, df.columns, min_rows, expected_columns, required, max_duplicate_rate)
    facts = [("total_null_cells", None, float(after["gaps"] or 0))]
    for side in sides:
        n = after[f"rows_{side}"]
        facts.append(("rows", side, float(n)))
        facts += [("anomaly_share", side, after[f"ones_{side}"] / n if n else None)] if target else []
    gates = spark.range(1).select(F.inline(F.array(*judged)))
    return gates, spark.createDataFrame(facts, "fact string, key string, value double")


def guarded(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """`df`, table or stream, that fails as soon as a row breaks a rule (a condition; NULL breaks it too).

    The test is part of the plan: whoever reads the rows meets the failure, and a stream stops at its micro-batch.
    """
    broken = F.concat_ws(", ", *[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    message = F.concat(F.lit("rules broken: "), broken)
    return df.where(F.assert_true(broken == "", message).isNull())


def only_past(df: DataFrame, gates: DataFrame) -> DataFrame:
    """`df` that fails when read if a gate of `gates` (see `gate_table`) does not pass; nothing is computed before.

    The verdict is a scalar subquery of the plan. A table without rows has none to stop at: see `enforce`.
    """
    told = F.format_string("gate %s failed: observed %s, threshold %s", "gate", F.col("observed").cast("string"), F.col("threshold").cast("string"))
    failure = gates.where("not passed").agg(F.min_by(told, "position").alias(FAILURE)).scalar()
    return df.withColumn(FAILURE, failure).where(F.assert_true(F.col(FAILURE).isNull(), F.col(FAILURE)).isNull()).drop(FAILURE)


def enforce(gates: DataFrame) -> None:
    """Stop at the first failing gate."""
    failed = gates.where("not passed").orderBy("position").limit(1).collect()
    if failed:
        gate = failed[0]
        raise GateFailure(f"gate {gate.gate} failed: observed {gate.observed}, threshold {gate.threshold}")


def clean_table_rules(df: DataFrame) -> DataFrame:
    """Assertions on the cleaned table: required columns, no nulls, numbers, value ranges."""
    required = ["duration", "src_bytes", "dst_bytes", "logged_in", "label"]
    kinds = dict(df.dtypes)
    numeric = all(kinds.get(c) in ("int", "bigint", "double", "float", "smallint", "tinyint") for c in ("duration", "src_bytes"))
    holds = lambda condition: F.coalesce(condition, F.lit(False))  # noqa: E731  a missing value breaks the rule
    nulls = sum((F.count_if(known(df, c).isNull()) for c in df.columns), F.lit(0))
    rules = {
        "required_columns": F.lit(all(c in kinds for c in required)),
        "no_nulls": nulls == 0,
        "numeric_types": F.lit(numeric),
    }
    if numeric:
        rules["non_negative"] = F.count_if(~holds((F.col("duration") >= 0) & (F.col("src_bytes") >= 0))) == 0
    if "logged_in" in kinds:
        rules["binary_login"] = F.count_if(~holds(F.col("logged_in").isin(0, 1))) == 0
    rows = [F.struct(F.lit(name).alias("rule"), passed.alias("passed")) for name, passed in rules.items()]
    return df.agg(F.array(*rows).alias("_rules")).select(F.inline("_rules"))
