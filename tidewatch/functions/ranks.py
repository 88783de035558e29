"""Exact order statistics and running counts without ordering a whole large group in one task.

While a group holds more rows than one task should order (TASK_ROWS), its value range is cut
into FANOUT ** LEVELS ordered cells of about equal size by a mergeable sketch, and again
inside each cell if needed. Cells are exact: every row is counted in one of them, equal
values always share one, and only the cells' totals are ordered across the group. The sketch
steers the work and never decides a result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.joins import BROADCAST_ROWS, attach, fits_broadcast
from tidewatch.functions.scalars import not_missing
from tidewatch.functions.storage import materialize

TASK_ROWS = 4_000_000
FANOUT, LEVELS = 8, 3
CELLS = FANOUT ** LEVELS
ACCURACY = 10_000
CUT_CELLS = 2_000_000  # most cell edges to broadcast: 16 MB


def _keyed(df: DataFrame, value: str, groups: list[str], extra: list[Column] = ()) -> tuple[DataFrame, list[str]]:
    """(keys…, _x, extra…) without missing values or groups; `_all` stands in for no groups."""
    keys = groups or ["_all"]
    lead = [F.col(g) for g in groups] or [F.lit(0).alias("_all")]
    rows = df.select(*lead, F.col(value).cast("double").alias("_x"), *extra)
    present = [F.col(g).isNotNull() for g in groups]
    return rows.where(reduce(lambda a, b: a & b, present, not_missing(F.col("_x")))), keys


def _sizes(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, bool, int]:
    """Rows per group, whether the groups are few enough to broadcast, and the largest group."""
    sizes = materialize(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    groups, largest = sizes.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    return sizes, groups <= BROADCAST_ROWS and fits_broadcast(sizes), largest


def _with_cuts(rows: DataFrame, sketch: DataFrame, keys: list[str], small: bool) -> DataFrame:
    if keys == ["_all", "_cell"] and sketch.count() == 1:
        whole = sketch.select("_cuts").scalar()
        return rows.withColumn("_cuts", whole)
    return attach(rows, sketch, keys, "inner", small)


def _refine(rows: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Replace `_cell` by cells CELLS times finer, numbered in value order.

    The edges come from one mergeable sketch per cell, stored so that every reader sees the
    same; a row finds its cell level by level with FANOUT - 1 comparisons each.
    """
    inner = [*keys, "_cell"]
    probs = ", ".join(f"{i / CELLS!r}D" for i in range(1, CELLS))
    cuts = F.expr(f"percentile_approx(_x, array({probs}), {ACCURACY})")
    sketch = materialize(rows.groupBy(*inner).agg(cuts.alias("_cuts")))
    found, located = "0", _with_cuts(rows, sketch, inner, few and fits_broadcast(sketch, CUT_CELLS // CELLS))
    for level in range(LEVELS - 1, -1, -1):
        step = FANOUT ** level
        below = " + ".join(f"IF(get(_cuts, {found} + {j * step - 1}) <= _x, 1, 0)" for j in range(1, FANOUT))
        located = located.withColumn(f"_b{level}", F.expr(f"{found} + {step} * ({below})"))
        found = f"_b{level}"
    return located.withColumn("_cell", F.expr(f"_cell * {CELLS} + {found}")).select(*rows.columns)


def before(measure: str, partition: list[str], order: str) -> Column:
    """Running sum of `measure` over the rows before the current one."""
    frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(frame), F.lit(0))


def upto(measure: str, partition: list[str], order: str) -> Column:
    frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(measure).over(frame)


def _between(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation measured from the nearer end, so that t = 1 gives b exactly."""
    return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t))


def exact_quantiles(
    df: DataFrame, value: str, probs: list[float], groups: list[str] = (), keep_input: bool = False,
    position: Callable[[float, Column], Column] = lambda p, n: F.lit(p) * (n - 1),
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group (groups…, n, quantiles array).

    Groups that fit one task are ordered directly, after equal values have collapsed. Larger
    ones go through rounds: cut into cells, count them exactly, keep only the cells holding a
    wanted rank. A round leaves about 1/CELLS of the rows per wanted rank.

    `keep_input` stores group and value first, for inputs dearer to derive (a join) than to
    read back. `position` turns a probability and the row count into a 0-based rank.
    """
    groups = list(groups)
    rows, keys = _keyed(df, value, groups)
    if keep_input:
        rows = materialize(rows)
    sizes, few, largest = _sizes(rows, keys)

    places = [position(p, F.col("n")) for p in probs]
    low = [F.floor(p) for p in places]
    high = [F.ceil(p) for p in places]
    ranks = F.array_distinct(F.array(*low, *high))
    sized = lambda frame: attach(frame, sizes, keys, "inner", few) if groups else frame.withColumn(
        "n", sizes.select("n").scalar())

    cell = [*keys, "_cell"]
    start = [F.lit(0).cast("long").alias("_cell"), F.lit(0).cast("long").alias("_before")]
    if few:
        rows = rows.select(*keys, *start, "_x", F.lit(1).cast("long").alias("_w"))
    else:  # many groups mean shuffle joins: collapse equal values first, so no hot value travels as rows
        rows = rows.groupBy(*keys, "_x").agg(F.count("*").alias("_w")).select(*keys, *start, "_x", "_w")
    rounds = 0
    while largest > TASK_ROWS:
        located = _refine(rows, keys, few)
        pieces = located.groupBy(*cell).agg(
            F.sum("_w").alias("_in"), F.count("*").alias("_rows"), F.max("_before").alias("_base")
        ).withColumn("_parent", F.floor(F.col("_cell") / CELLS))
        start_at = F.col("_base") + before("_in", [*keys, "_parent"], "_cell")
        wanted = F.exists(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in")))
        needed = materialize(
            sized(pieces.withColumn("_before", start_at)).where(wanted).select(*cell, "_before", "_rows")
        )
        inside = attach(located.drop("_before"), needed.select(*cell, "_before"), cell, "inner", fits_broadcast(needed))
        # From here on one row per distinct value, so the next cut is even over values, not copies.
        rows = materialize(
            inside.groupBy(*cell, "_before", "_x").agg(F.sum("_w").alias("_w")).select(*cell, "_before", "_x", "_w")
        )
        largest = rows.groupBy(*cell).agg(F.count("*").alias("r")).agg(F.coalesce(F.max("r"), F.lit(0))).first()[0]
        rounds += 1

    counts = rows.groupBy(*cell, "_before", "_x").agg(F.sum("_w").alias("_c")) if rounds == 0 else (
        rows.withColumnRenamed("_w", "_c"))
    ended = sized(counts.withColumn("_end", F.col("_before") + upto("_c", cell, "_x")))
    hit = F.filter(ranks, lambda r: (r >= F.col("_end") - F.col("_c")) & (r < F.col("_end")))
    picked = ended.select(*keys, "n", "_x", F.explode(hit).alias("_rank")).groupBy(*keys).agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at")
    )
    at = F.col("_at")
    values = [_between(at[lo], at[hi], place - lo) for place, lo, hi in zip(places, low, high)]
    return picked.select(*groups, "n", F.array(*values).alias("quantiles"))


def cell_counts(
    df: DataFrame, value: str, measures: dict[str, Column], groups: list[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Sums of `measures` per distinct value `_x`, each tagged with an ordered `_cell`.

    A cell holds TASK_ROWS distinct values at most, so a window over (keys, _cell) is one task's
    work; totals of cells are then ordered per group. Returns the counts and the key columns.
    """
    names, groups = list(measures), list(groups)
    rows, keys = _keyed(df, value, groups, [m.alias(k) for k, m in measures.items()])
    _, few, largest = _sizes(rows, keys)
    sums = [F.sum(n).alias(n) for n in names]
    # One row per distinct value, so cells are even over values and copies can't fill one.
    rows = rows.groupBy(*keys, "_x").agg(*sums).withColumn("_cell", F.lit(0).cast("long"))
    cell = [*keys, "_cell"]
    while largest > TASK_ROWS:
        rows = materialize(_refine(rows, keys, few))
        largest = rows.groupBy(*cell).agg(F.count("*").alias("r")).agg(F.coalesce(F.max("r"), F.lit(0))).first()[0]
    return rows.select(*cell, "_x", *names), keys
