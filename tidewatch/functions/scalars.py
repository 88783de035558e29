"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMBER_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
GROUPED_DIGITS = r"(?<=\d)_(?=\d)"


def text(value: Column) -> Column:
    return value.cast("string")


def not_missing(value: Column) -> Column:
    """Null and NaN both count as missing."""
    return value.isNotNull() & ~F.isnan(value)


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL, so that aggregates and comparisons skip both."""
    return F.nanvl(F.col(name), F.lit(None).cast(df.schema[name].dataType)) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else F.col(name)


def clean_label(label: Column) -> Column:
    """Undo a printed bytes literal (b'x.') and strip all trailing dots."""
    bare = F.replace(F.replace(text(label), F.lit("b'"), F.lit("")), F.lit("'"), F.lit(""))
    return F.rtrim(bare, F.lit("."))


def map_values(value: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Dictionary lookup with a default; the dictionary is a literal in the plan."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(table[value], F.lit(default))


def log1p_clipped(value: Column) -> Column:
    """log(1 + max(x, 0)); NULL stays NULL although `greatest` would skip it."""
    return F.when(value.isNotNull(), F.log1p(F.greatest(value.cast("double"), F.lit(0.0))))


def grouped_flag(value: Column) -> Column:
    """0 for an exact 0, else 1; a missing value counts as 1."""
    return F.when(value.eqNullSafe(F.lit(0)), 0).otherwise(1)


def parse_number(value: Column) -> Column:
    """Number in a text cell, or NULL. Rejects suffixes such as '5d' that a cast accepts."""
    cell = F.trim(text(value))
    return F.when(cell.rlike(NUMBER_TEXT), cell.try_cast("double"))


def parse_float_literal(value: Column) -> Column:
    """Like `parse_number`, also accepting digit groups written with underscores (1_000)."""
    return parse_number(F.regexp_replace(text(value), GROUPED_DIGITS, ""))


def number_or_zero(value: Column, kind: T.DataType | None = None) -> Column:
    """0 for what is missing or no number; a column known to be numeric is not printed and parsed again."""
    number = value.cast("double") if isinstance(kind, T.NumericType) else parse_number(value)
    return F.when(not_missing(number), number).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Division giving NULL on a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def bin_of(value: str, edges: str, count: int) -> Column:
    """Number of edges at or below `value`; a plain sum, so it stays inside generated code."""
    return F.expr(" + ".join(f"IF({edges}[{i}] <= {value}, 1, 0)" for i in range(count)))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def digested(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Text columns but those in `keep` as 32-byte digests, equal exactly where the texts are: for counting without moving texts."""
    return df.withColumns({c: F.unhex(F.sha2(F.col(c), 256)) for c in text_columns(df, exclude=keep)})


def long_form(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep…, feature, value) with one row per column, values as double."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns if c not in keep]
    return df.select(*keep, *doubles).unpivot(list(keep), columns, "feature", "value")
