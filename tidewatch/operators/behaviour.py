"""Trailing-window features of a connection: the last seconds, and the last connections per host.

A host or service may hold a large part of all rows, so nothing is partitioned by it. Every row
enters one long table of marks, for each kind of frame (host; service; host and service; ...): a
mark with what it adds, one where it leaves the frames of later rows, and where needed one where its own frame ends. The table
is ordered by kind, key and position, and running sums go over that order in cells of equal size
(`functions.prefix`): what has been added and not yet left is the frame at a row, as no key's rows outlast the key.

The input is read twice: once for the keys, positions and measures, and once for the join
that adds all features at the same time.

`connection_features` spares this the keys that a task can order by itself (TASK_ROWS, counted): a
running sum up to the row less the one up to where its frame starts, over the key's rows in their order. Both ways give the same sums.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tidewatch.functions.joins import fits_broadcast
from tidewatch.functions.prefix import running_number, running_sums
from tidewatch.functions.scalars import ratio
from tidewatch.functions.storage import materialize

MICROS = 1_000_000
#: `connection_features` orders the rows of a key in one task up to this many; a larger key is cut into cells.
TASK_ROWS = 1_000_000
#: Marks of a cell, where the session's number of shuffle partitions would make it larger.
CELL_MARKS = 1_000_000
#: Rows of small keys that make a task of their own.
PIECE_ROWS = 200_000
#: Hosts whose earlier connections are looked for by name; with more of them all are read.
NAMED_HOSTS = 200_000
#: Order of the marks at one position: a row leaves all later frames, a row adds, a frame's end.
LEAVES, ADDS, END = 0, 1, 2


def _on_known(df: DataFrame, needed: list[str], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply `build` to rows with all needed values; other rows stay, with NULL features."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    return build(df.where(known)).unionByName(df.where(~known), allowMissingColumns=True)


def frame_sums(
    base: DataFrame, rows: Sequence[str], kinds: Mapping[str, Sequence[str]], position: str, reach: int,
    measures: Sequence[str], peers: bool, cells: int | None = None,
) -> DataFrame:
    """Sums of the measures over each row's frames: (rows…, `<kind>_<measure>`…), one row for each of `base`.

    A kind's frame holds the rows of `base` equal in the kind's columns (NULL equals NULL) with a position in
    [p - reach, p]. `rows` tell the rows of `base` apart. `peers`: several rows of a key may share a position.
    """
    keys = sorted({c for columns in kinds.values() for c in columns})
    at = F.col(position)
    tags = [(LEAVES, at + reach + 1), (ADDS, at), (END, at)] if peers else [(LEAVES, at + reach + 1), (ADDS, at)]
    signs = {LEAVES: -1, ADDS: 1, END: 0}
    marks = [
        F.struct(
            F.lit(k).alias("_kind"), *[(F.col(c) if c in columns else F.lit(None).cast(base.schema[c].dataType)).alias(f"_key_{c}") for c in keys],
            where.alias("_at"), F.lit(tag).alias("_tag"), *[(F.col(m) * signs[tag]).cast("long").alias(f"_sum_{m}") for m in measures],
        )
        for k, columns in enumerate(kinds.values()) for tag, where in tags
    ]
    table = base.select(*rows, F.inline(F.array(*marks)))
    order = ["_kind", *[f"_key_{c}" for c in keys], "_at", "_tag", *(rows if peers else [])]
    # All that a key adds leaves again within the key, so the sum over the whole order is the frame's.
    own = running_sums(table, order, [f"_sum_{m}" for m in measures], cells).where(F.col("_tag") == (END if peers else ADDS))
    if len(kinds) == 1:
        return own.select(*rows, *[F.col(f"_sum_{m}").alias(f"{kind}_{m}") for kind in kinds for m in measures])
    return own.groupBy(*rows).agg(
        *[F.sum(F.when(F.col("_kind") == k, F.col(f"_sum_{m}"))).alias(f"{kind}_{m}") for k, kind in enumerate(kinds) for m in measures])


def _flag(condition: Column | None) -> Column:
    """1 where the condition holds; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int") if condition is not None else F.lit(0)


def _last_sums(
    known: DataFrame, host: str, service: str, ts: str, row_id: str, syn_error: Column | None, rejected: Column | None,
    source_port: str | None, source: str | None, last: int, cells: int | None,
) -> DataFrame:
    """(_row, `_h_n`, …): sums over the last connections to the host, by marks."""
    extra = {"_port": source_port, "_source": source}
    base = known.select(
        F.col(row_id).alias("_row"), F.col(host).alias("_host"), F.col(service).alias("_service"), F.col(ts).alias("_ts"),
        *[F.col(c).alias(name) for name, c in extra.items() if c is not None], F.lit(1).alias("n"), _flag(syn_error).alias("syn"), _flag(rejected).alias("rej"),
    )
    numbered = running_number(base, ["_host", "_ts", "_row"], "_k", cells)
    kinds = {"_h": ["_host"], "_s": ["_host", "_service"]}
    kinds |= {"_p": ["_host", "_port"]} if source_port is not None else {}
    kinds |= {"_d": ["_host", "_service", "_source"]} if source is not None else {}
    return frame_sums(numbered, ["_row"], kinds, "_k", last - 1, ["n", "syn", "rej"], False, cells)


def _seconds_columns() -> dict[str, Column]:
    """The columns over the last seconds, of the sums of host (_h), service (_s) and both (_b)."""
    n, m, both = F.col("_h_n"), F.col("_s_n"), F.col("_b_n")
    return {
        "count": n, "srv_count": m,
        "serror_rate": ratio(F.col("_h_syn"), n), "srv_serror_rate": ratio(F.col("_s_syn"), m),
        "rerror_rate": ratio(F.col("_h_rej"), n), "srv_rerror_rate": ratio(F.col("_s_rej"), m),
        "same_srv_rate": ratio(both, n), "diff_srv_rate": 1.0 - ratio(both, n), "srv_diff_host_rate": 1.0 - ratio(both, m),
    }


def _last_columns(prefix: str, source_port: str | None, source: str | None) -> dict[str, Column]:
    """The columns over the last connections, of the sums of `_last_sums` under a prefix."""
    sums = lambda name: F.col(f"{prefix}{name}")
    n, m = sums("h_n"), sums("s_n")
    columns = {
        "dst_host_count": n, "dst_host_srv_count": m, "dst_host_same_srv_rate": ratio(m, n), "dst_host_diff_srv_rate": 1.0 - ratio(m, n),
        "dst_host_serror_rate": ratio(sums("h_syn"), n), "dst_host_srv_serror_rate": ratio(sums("s_syn"), m),
        "dst_host_rerror_rate": ratio(sums("h_rej"), n), "dst_host_srv_rerror_rate": ratio(sums("s_rej"), m),
    }
    columns |= {"dst_host_same_src_port_rate": ratio(sums("p_n"), n)} if source_port is not None else {}
    columns |= {"dst_host_srv_diff_host_rate": 1.0 - ratio(sums("d_n"), m)} if source is not None else {}
    return columns


def two_second_features(
    df: DataFrame, host: str, service: str, ts: str,
    syn_error: Column | None = None, rejected: Column | None = None,
    seconds: int = 2, cells: int | None = None,
) -> DataFrame:
    """The nine same-host / same-service columns over the last `seconds` (current row included).

    Connections of one host and service at one instant share their frames, so they are summed first.
    """
    def build(known: DataFrame) -> DataFrame:
        instant = F.unix_micros(F.col(ts).cast("timestamp"))
        rows = ["_host", "_service", "_t"]
        base = known.select(
            F.col(host).alias("_host"), F.col(service).alias("_service"), instant.alias("_t"), _flag(syn_error).alias("syn"), _flag(rejected).alias("rej")
        ).groupBy(*rows).agg(F.count("*").alias("n"), F.sum("syn").alias("syn"), F.sum("rej").alias("rej"))
        kinds = {"_h": ["_host"], "_s": ["_service"], "_b": ["_host", "_service"]}
        sums = frame_sums(base, rows, kinds, "_t", seconds * MICROS, ["n", "syn", "rej"], True, cells)
        features = _seconds_columns()
        named = sums.select(*rows, *[c.alias(name) for name, c in features.items()])
        same = (known[host] == named["_host"]) & (known[service] == named["_service"]) & (instant == named["_t"])
        return known.join(named, same).select(*[known[c] for c in known.columns], *features)

    return _on_known(df, [host, service, ts], build)


def hundred_connection_features(
    df: DataFrame, host: str, service: str, ts: str, row_id: str,
    syn_error: Column | None = None, rejected: Column | None = None,
    source_port: str | None = None, source: str | None = None,
    last: int = 100, cells: int | None = None,
) -> DataFrame:
    """The dst_host_* columns over the last `last` connections to the host (current row included).

    All rows are numbered by (host, ts, row_id) first; the number says which of a host's connections
    are recent enough, for every kind of frame. `row_id` must tell rows apart; rows without one keep NULL features.
    """
    def build(known: DataFrame) -> DataFrame:
        sums = _last_sums(known, host, service, ts, row_id, syn_error, rejected, source_port, source, last, cells)
        named = sums.select("_row", *[c.alias(name) for name, c in _last_columns("_", source_port, source).items()])
        return known.join(named, known[row_id] == named["_row"]).select(*[known[c] for c in known.columns], *named.columns[1:])

    return _on_known(df, [host, service, ts, row_id], build)


def _frame(order: WindowSpec, reach: int, measures: Mapping[str, Column], prefix: str, by_rows: bool = False) -> dict[str, Column]:
    """Sums over the rows from `reach` before (positions, or rows) up to this one; each row is read twice, whatever the frames hold."""
    between = order.rowsBetween if by_rows else order.rangeBetween
    upto, before = between(Window.unboundedPreceding, 0), between(Window.unboundedPreceding, -(reach + 1))
    return {f"{prefix}_{m}": F.sum(c).over(upto) - F.coalesce(F.sum(c).over(before), F.lit(0)) for m, c in measures.items()}


def _counted(rows: DataFrame, key: str) -> tuple[int, list]:
    """The number of rows, and the keys too large for one task."""
    large = F.collect_list(F.when(F.col("count") > TASK_ROWS, F.col(key)))
    found = rows.groupBy(key).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), large.alias("large")).first()
    return found["n"], found["large"]


def _cells(spark: SparkSession, rows: int, marks: int) -> int | None:
    """Cells for so many rows; None leaves them to the session's number of shuffle partitions."""
    pieces = -(-rows * marks // CELL_MARKS)
    return pieces if pieces > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def connection_features(
    df: DataFrame, host: str, service: str, ts: str, row_id: str,
    syn_error: Column | None = None, rejected: Column | None = None,
    source_port: str | None = None, source: str | None = None,
    seconds: int = 2, last: int = 100, cells: int | None = None, since: int | None = None,
) -> DataFrame:
    """Both sets of columns: the last seconds, and the last connections to the host.

    `since` (microseconds): only rows of this instant or later come back; those before are what their frames reach back to.
    """
    spark, reach, names = df.sparkSession, seconds * MICROS, ["n", "syn", "rej"]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (host, service, ts)])
    rows = df.where(known).withColumns({
        "_t": F.unix_micros(F.col(ts).cast("timestamp")), "_n": F.lit(1), "_syn": _flag(syn_error), "_rej": _flag(rejected),
        "_own": F.col(row_id).isNotNull().cast("int"),
    })
    wanted = F.lit(True) if since is None else F.col("_t") >= since
    measures = {m: F.col(f"_{m}") for m in names}
    own = {m: F.col(f"_{m}") * F.col("_own") for m in names}

    # The service's frames, of instants: connections of a service at one instant share them.
    near = rows if since is None else rows.where(F.col("_t") >= since - reach)
    instants = near.groupBy(F.col(service).alias("_service"), F.col("_t").alias("_time")).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
    count, large = _counted(near, service)
    small = instants.where(~F.col("_service").isin(large)) if large else instants
    by_time = Window.partitionBy("_service").orderBy("_time")
    sums = small.withColumns(_frame(by_time, reach, {m: F.col(m) for m in names}, "_s")).drop(*names)
    if large:
        apart = instants.where(F.col("_service").isin(large))
        sums = sums.unionByName(frame_sums(apart, ["_service", "_time"], {"_s": ["_service"]}, "_time", reach, names, False, cells or _cells(spark, count, 2)))

    # The host's frames: earlier connections of hosts without a wanted row are left out if these are few enough to be named.
    if since is not None:
        hosts = materialize(rows.where(wanted).select(host).distinct())
        rows = rows.join(F.broadcast(hosts), host, "left_semi") if fits_broadcast(hosts, NAMED_HOSTS) else rows
    count, large = _counted(rows, host)
    small = rows.where(~F.col(host).isin(large)) if large else rows
    pieces = -(-count // PIECE_ROWS)
    small = small.repartition(pieces, host) if pieces > int(spark.conf.get("spark.sql.shuffle.partitions")) else small
    # Connections without an id come first and add nothing to the numbers.
    numbers = Window.partitionBy(host).orderBy("_own", "_t", row_id)
    number = F.sum("_own").over(numbers.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    small = small.withColumns({"_k": number} | _frame(numbers, last - 1, own, "_last_h", by_rows=True))
    small = small.withColumns(_frame(Window.partitionBy(host).orderBy("_t"), reach, measures, "_h"))
    small = small.withColumns(_frame(Window.partitionBy(host, service).orderBy("_t"), reach, {"n": F.col("_n")}, "_b"))
    small = small.withColumns(_frame(Window.partitionBy(host, service).orderBy("_k"), last - 1, own, "_last_s"))
    kinds = {"_last_p": [host, source_port]} if source_port is not None else {}
    kinds |= {"_last_d": [host, service, source]} if source is not None else {}
    for kind, keys in kinds.items():
        small = small.withColumns(_frame(Window.partitionBy(*keys).orderBy("_k"), last - 1, {"n": F.col("_own")}, kind))
    found = small.drop("_k")
    if large:
        hot = rows.where(F.col(host).isin(large))
        instant = {"_host": F.col(host), "_service": F.col(service), "_time": F.col("_t")}
        base = hot.groupBy(*[c.alias(name) for name, c in instant.items()]).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
        times = frame_sums(base, list(instant), {"_h": ["_host"], "_b": ["_host", "_service"]}, "_time", reach, names, True, cells or _cells(spark, count, 6))
        lasts = _last_sums(hot.where("_own = 1"), host, service, ts, row_id, syn_error, rejected, source_port, source, last, cells or _cells(spark, count, 8))
        lasts = lasts.select("_row", *[F.col(c).alias(f"_last{c}") for c in lasts.columns if c != "_row"])
        same = reduce(lambda a, b: a & b, [c == times[name] for name, c in zip(instant, (hot[host], hot[service], hot["_t"]))])
        marked = hot.join(times, same).join(lasts, hot[row_id] == lasts["_row"], "left")
        found = found.unionByName(marked.select(*found.columns))

    found = found.where(wanted).join(sums, (F.col(service) == F.col("_service")) & (F.col("_t") == F.col("_time")))
    recent = _last_columns("_last_", source_port, source)
    features = _seconds_columns() | {name: F.when(F.col("_own") == 1, c) for name, c in recent.items()}
    featured = found.select(*df.columns, *[c.alias(name) for name, c in features.items()])
    return featured if since is not None else featured.unionByName(df.where(~known), allowMissingColumns=True)
