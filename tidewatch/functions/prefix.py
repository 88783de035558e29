"""Running sums and numbers over an order of all rows, cut into cells of about equal size.

No key decides where a row goes: rows are range-partitioned by the whole order, so a key that
holds half of all rows reaches over many cells. Cells are stored (their bounds are drawn from a sample
and must not change between readers), summed, and each cell starts where the ones before it end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.functions.storage import materialize

CELL = "_cell"


def in_cells(df: DataFrame, order: Sequence[str], cells: int | None = None) -> DataFrame:
    """`df` with `_cell`: cells follow the order and split it anywhere but between rows equal in all of it."""
    dealt = df.repartitionByRange(*([cells] if cells else []), *order)
    return materialize(dealt.withColumn(CELL, F.spark_partition_id()))


def running_sums(df: DataFrame, order: Sequence[str], measures: Sequence[str], cells: int | None = None) -> DataFrame:
    """`df` with each measure replaced by its sum over all rows up to this one in the order.

    The difference of two such sums counts what lies between, whatever the keys are. Measures should be
    whole numbers; `order` should tell rows apart, as the place among equal rows is left open.
    """
    rows = in_cells(df, order, cells)
    # One row for each cell, that is, for each partition.
    earlier = Window.orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(CELL).agg(*[F.sum(m).alias(m) for m in measures])
    starts = totals.select(CELL, *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_start_{m}") for m in measures])
    inside = Window.partitionBy(CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({m: F.sum(m).over(inside) for m in measures}).join(F.broadcast(starts), CELL)
    return summed.select(*[(F.col(c) + F.col(f"_start_{c}")).alias(c) if c in measures else F.col(c) for c in df.columns])


def running_number(df: DataFrame, order: Sequence[str], output: str, cells: int | None = None) -> DataFrame:
    """`df` with the 1-based number of each row in the order."""
    return running_sums(df.withColumn(output, F.lit(1).cast("long")), order, [output], cells)
