"""Left lookups that stay safe when the dimension grows or one key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.functions.storage import materialize

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 16 << 20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: 8 for each column, and the length of text, binary and array columns."""
    sizes = [F.lit(8 * len(df.columns))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType):
            sizes.append(8 * F.greatest(F.size(f.name), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)


def fits_broadcast(dim: DataFrame, row_bound: int = BROADCAST_ROWS, byte_bound: int = BROADCAST_BYTES) -> bool:
    """True when `dim` keeps both bounds, counted; reads just past the row bound at most."""
    size = dim.limit(row_bound + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(dim)), F.lit(0)).alias("b")).first()
    return size["n"] <= row_bound and size["b"] <= byte_bound


def attach(df: DataFrame, dim: DataFrame, keys: list[str], how: str, small: bool) -> DataFrame:
    """Join `dim` to `df`: broadcast when known small, else a shuffle join.

    A key that holds a large part of `df` is split by adaptive execution: both sides come straight
    from an exchange that the join itself asks for, so equal rows are spread as well.
    """
    added = [] if how == "left_semi" else [c for c in dim.columns if c not in keys]
    return df.join(F.broadcast(dim) if small else dim, keys, how).select(*df.columns, *added)


def lookup_join(
    df: DataFrame, dim: DataFrame, keys: list[str], how: str = "left", row_bound: int = BROADCAST_ROWS
) -> DataFrame:
    """Look up a fitted table by key: computed once, its size checked, then joined."""
    fitted = materialize(dim)
    return attach(df, fitted, keys, how, fits_broadcast(fitted, row_bound))
