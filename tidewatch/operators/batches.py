"""Batch validation: one incident per defect, a verdict per batch, routing of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch import vocabulary as v
from tidewatch.functions.joins import lookup_join
from tidewatch.functions.scalars import digested, parse_float_literal, text

FIELDS = ["type", "severity", "column", "row_id", "value", "detail"]


def _incident(kind: str, detail: Column, column: Column | None = None,
              row_id: Column | None = None, value: Column | None = None) -> Column:
    empty = F.lit(None).cast("string")
    parts = {
        "type": F.lit(kind), "severity": F.lit(v.SEVERITY[kind]),
        "column": empty if column is None else column,
        "row_id": empty if row_id is None else text(row_id),
        "value": empty if value is None else text(value),
        "detail": detail,
    }
    return F.struct(*[parts[f].alias(f) for f in FIELDS])


def _say(kind: str, *parts: Column) -> Column:
    return F.format_string(v.INCIDENT_TEXT[kind], *[text(p) for p in parts])


def cell_incidents(
    df: DataFrame, expected: Mapping[str, str], row_id: str, batch: str,
    allowed: Sequence[str] = v.PROTOCOLS, value_range: tuple[float, float] = v.VALUE_RANGE,
) -> DataFrame:
    """One row per bad cell: not a number, outside the range, or an unknown category.

    Purely row-wise (no shuffle). A text 'nan' reads as a number and is no incident.
    """
    checks = []
    for c, kind in expected.items():
        if c not in df.columns:
            continue
        cell, name, row = F.col(c), F.lit(c), F.col(row_id)
        if kind == "numeric":
            number, outside = _number(df, c, value_range)
            checks.append(
                F.when(cell.isNull(), None)
                .when(number.isNull(), _incident("INCORRECT_DATATYPE", _say("INCORRECT_DATATYPE", row, name, cell), name, row, cell))
                .when(outside, _incident("EXTREME_OUTLIER", _say("EXTREME_OUTLIER", row, name, cell), name, row, cell))
            )
        elif kind == "categorical":
            checks.append(F.when(
                ~cell.isin(*allowed),
                _incident("UNKNOWN_CATEGORY", _say("UNKNOWN_CATEGORY", row, name, cell), name, row, cell),
            ))
    return df.select(batch, F.inline(F.array_compact(F.array(*checks))))


def _number(df: DataFrame, c: str, value_range: tuple[float, float]) -> tuple[Column, Column]:
    """A cell as a number (a column known to be numeric is not printed and parsed), and whether it lies outside the range."""
    number = F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else parse_float_literal(F.col(c))
    return number, ~F.isnan(number) & ((number < value_range[0]) | (number > value_range[1]))


def _bad_cells(df: DataFrame, expected: Mapping[str, str], allowed: Sequence[str], value_range: tuple[float, float]) -> Column:
    """How many cells of a row are incidents, without wording them."""
    bad = [F.lit(0)]
    for c, kind in expected.items():
        if c in df.columns and kind == "numeric":
            number, outside = _number(df, c, value_range)
            bad.append((F.col(c).isNotNull() & (number.isNull() | outside)).cast("int"))
        elif c in df.columns and kind == "categorical":
            bad.append(F.coalesce(~F.col(c).isin(*allowed), F.lit(False)).cast("int"))
    return reduce(lambda a, b: a + b, bad)


def counted_verdict(
    df: DataFrame, expected: Mapping[str, str], row_id: str, batch: str,
    allowed: Sequence[str] = v.PROTOCOLS, value_range: tuple[float, float] = v.VALUE_RANGE,
) -> DataFrame:
    """`batch_verdict` of a frame's own incidents, counted and not worded: one grouped pass, and one over digests for copies."""
    data = [c for c in df.columns if c not in (row_id, batch)]
    checked = [c for c in expected if c in data]
    missing, extra = any(c not in data for c in expected), any(c not in expected for c in data)
    cells = F.sum(_bad_cells(df, expected, allowed, value_range))
    gaps = reduce(lambda a, b: a + b, [F.max(F.col(c).isNull().cast("int")) for c in checked], F.lit(0))
    counts = df.groupBy(batch).agg(cells.alias("_cells"), gaps.alias("_gaps"))
    copies = row_copies(digested(df, keep=[batch]), row_id, batch).groupBy(F.col(batch).alias("_copied")).agg((F.max("_n") > 1).cast("int").alias("_copies"))
    n = F.col("_cells") + F.col("_gaps") + F.col("_copies") + int(missing) + int(extra)
    blocked = F.lit(missing) | (F.col("_cells") > 0)
    return counts.join(copies, F.col(batch).eqNullSafe(F.col("_copied"))).select(
        batch, F.when(blocked, v.VERDICT_FAILED[0]).otherwise(v.VERDICT_PASSED[0]).alias("status"),
        F.when(blocked, v.VERDICT_FAILED[1]).otherwise(v.VERDICT_PASSED[1]).alias("action"), n.cast("long").alias("total_incidents"),
    )


def batch_counts(df: DataFrame, expected: Mapping[str, str], row_id: str, batch: str) -> DataFrame:
    """(batch, one count of nulls per checked column); counts of parts of a batch add up."""
    checked = [c for c in expected if c in df.columns and c not in (row_id, batch)]
    return df.groupBy(batch).agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in checked])


def row_copies(df: DataFrame, row_id: str, batch: str) -> DataFrame:
    """(batch, data columns, _n): how often each row occurs, whatever its id."""
    return df.groupBy(batch, *[c for c in df.columns if c not in (row_id, batch)]).agg(F.count("*").alias("_n"))


def counted_incidents(counts: DataFrame, copies: DataFrame, data_columns: Sequence[str], expected: Mapping[str, str], batch: str) -> DataFrame:
    """Schema, missing values and duplicates, from the finished counts of each batch."""
    missing = [c for c in expected if c not in data_columns]
    extra = [c for c in data_columns if c not in expected]

    whole = []
    if missing:
        whole.append(_incident("SCHEMA_ERROR", F.lit(v.INCIDENT_TEXT["SCHEMA_ERROR"] % missing)))
    if extra:
        whole.append(_incident("SCHEMA_MODIFICATION", F.lit(v.INCIDENT_TEXT["SCHEMA_MODIFICATION"] % extra)))
    nulls = {c: F.col(f"_null_{c}") for c in expected if c in data_columns}
    whole += [
        F.when(n > 0, _incident("MISSING_VALUES", _say("MISSING_VALUES", F.lit(c), n), F.lit(c), value=n))
        for c, n in nulls.items()
    ]
    per_batch = counts.select(batch, F.inline(F.array_compact(F.array(*whole)))) if whole else None

    extras = copies.groupBy(batch).agg(F.sum(F.col("_n") - 1).alias("_extra")).where("_extra > 0")
    duplicated = _incident("DUPLICATED_ROWS", _say("DUPLICATED_ROWS", F.col("_extra")), value=F.col("_extra"))
    duplicates = extras.select(batch, F.inline(F.array(duplicated)))
    return duplicates if per_batch is None else per_batch.unionByName(duplicates)


def batch_incidents(
    df: DataFrame, expected: Mapping[str, str], row_id: str, batch: str,
    allowed: Sequence[str] = v.PROTOCOLS, value_range: tuple[float, float] = v.VALUE_RANGE,
) -> DataFrame:
    """All incidents: schema, duplicates, missing values and bad cells, per batch."""
    data_columns = [c for c in df.columns if c not in (row_id, batch)]
    counted = counted_incidents(batch_counts(df, expected, row_id, batch), row_copies(df, row_id, batch), data_columns, expected, batch)
    cells = cell_incidents(df, expected, row_id, batch, allowed, value_range)
    return counted.unionByName(cells)


def batch_verdict(batches: DataFrame, incidents: DataFrame, batch: str) -> DataFrame:
    """(batch, status, action, total_incidents). A spotless batch also passes 'with warnings'."""
    summary = incidents.groupBy(F.col(batch).alias("_incident_batch")).agg(
        F.count("*").alias("_n"), F.bool_or(F.col("severity") == "HIGH").alias("_high")
    )
    high = F.coalesce(F.col("_high"), F.lit(False))
    failed, passed = v.VERDICT_FAILED, v.VERDICT_PASSED
    listed = batches.select(batch).distinct()
    return listed.join(summary, F.col(batch).eqNullSafe(F.col("_incident_batch")), "left").select(
        batch,
        F.when(high, failed[0]).otherwise(passed[0]).alias("status"),
        F.when(high, failed[1]).otherwise(passed[1]).alias("action"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("total_incidents"),
    )


def route(df: DataFrame, verdict: DataFrame, batch: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine): rows of batches that may go on, and rows of blocked batches.

    Rows naming no batch cannot be matched with a verdict and go to quarantine.
    """
    marked = lookup_join(df, verdict.select(batch, "action"), [batch])
    blocked = F.coalesce(F.col("action") == v.VERDICT_FAILED[1], F.lit(True))
    return marked.where(~blocked).drop("action"), marked.where(blocked).drop("action")
